import itertools

from corpusforge.llm import lookalike as L

ROWS = "doc_id bigint, text string, class_id string, key string"


def pairs(spark, texts):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in texts], ROWS)
    return sorted((r.doc_id_a, r.doc_id_b) for r in L.lookalike_pairs(df).collect())


def test_invisible_differences_meet_and_visible_ones_do_not(spark):
    same = ["a café fix-it now", "a café ﬁx‐it now", "а café fix​-it now", "ａ café fix-it now"]
    other = ["a cafe fix-it now", "a café fix—it now", "A café fix-it now", "a café fix-it  now", "α café fix-it now"]
    got = pairs(spark, list(enumerate(same + other)))
    assert got == sorted(itertools.combinations(range(len(same)), 2))


def test_superscripts_fractions_and_greek_stay(spark):
    assert pairs(spark, [(1, "10² m"), (2, "102 m"), (3, "½ m"), (4, "1/2 m"), (5, "ε-greedy"), (6, "e-greedy"), (7, "ℓ₂"), (8, "l2")]) == []


def test_repair_needs_the_corpus_vocabulary(spark):
    assert pairs(spark, [(1, "the mоdel works"), (2, "the model works")]) == [(1, 2)]
    # nobody writes the result: the odd spelling stays as it is
    forms = L.canonical_forms(spark.createDataFrame([(1, "the zоrblat works", "", "")], ROWS), with_text=True).collect()
    assert forms[0].form == "the zоrblat works"
    # two spellings that lead to one result vouch for it
    assert pairs(spark, [(1, "the zоrblat works"), (2, "the zorblаt works")]) == [(1, 2)]


def test_words_of_other_scripts_stay(spark):
    text = "слово мир"
    assert L.canonical_forms(spark.createDataFrame([(1, text, "", "")], ROWS), with_text=True).first().form == text


def test_nulls_empty_copies_and_long_texts(spark):
    long = "word " * 50_000
    got = pairs(spark, [(1, None), (None, "a"), (2, ""), (3, ""), (4, "same"), (5, "same"), (5, "same"), (6, long), (7, long.replace("w", "ｗ", 1))])
    assert got == [(6, 7)]
    assert pairs(spark, []) == []


def test_classes_count_spellings(spark):
    df = spark.createDataFrame([(1, "ａ b", "x", "y"), (2, "a b", "x", "y"), (3, "c", "x", "y")], ROWS)
    got = {r.doc_id: (r.class_id, r.n_spellings) for r in L.form_classes(df).collect()}
    assert got[1] == got[2] and got[1][1] == 2 and got[3][1] == 1


def test_the_dominant_script_of_a_token_is_the_one_it_is_written_in(spark):
    # Latin letters in words of Cyrillic and Greek, and foreign letters of several kinds in Latin words
    same = [("сумма слов", "суммa слов"), ("ο λόγος εδώ", "ο λόγoς εδώ"), ("the paper here", "the pαper here"), ("one more find", "one more fιnd"), ("an Apple pie", "an Ꭺpple pie"), ("so good now", "so ɡood now")]
    texts = [(10 * i + j, t) for i, pair in enumerate(same) for j, t in enumerate(pair)]
    assert pairs(spark, texts) == [(10 * i, 10 * i + 1) for i in range(len(same))]
    alike = L.unicode_confusables(spark)
    assert alike.results("суммa")[0] == "сумма" and alike.results("pαper") == ["paper"]
    assert alike.results("α") == alike.results("αt") == alike.results("model") == alike.results("λόγος") == []


def test_a_word_of_the_vocabulary_goes_before_one_that_spellings_vouch_for(spark):
    # both mixed spellings could also be read in Cyrillic letters only; the vocabulary has the Latin word
    assert pairs(spark, [(1, "all ѕeеds are"), (2, "all ѕееdѕ are"), (3, "all seeds are")]) == [(1, 2), (1, 3), (2, 3)]
