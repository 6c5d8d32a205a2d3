import itertools
import random

from corpusforge.llm import names as N


def pairs(spark, entries):
    df = spark.createDataFrame([(e,) for e in entries], "name string")
    return sorted(tuple(r) for r in N.spelling_pairs(df.where("name is not null").distinct()).collect())


def all_pairs(*sets):
    return sorted(tuple(sorted(p)) for s in sets for p in itertools.combinations(s, 2))


JANA = ["Jana W. Dikcison", "Dikcison, J.", "DIKCISON Jana", "JW Dikcison", "Jana\xa0Dikcison", "Dr. Jana Dikcison", "Jana Dikcison (Univ. of X)", "jana w. dikcison"]
MIN_HO = ["Min-Ho C. Dikcison", "MHC Dikcison", "Dikcison, Min-Ho"]
BECKY = ["Rebecca van Neirmivan", "Becky van Neirmivan", "R. Neirmivan", "Rebecca van Neirmivna"]
GROUP = ["Yudcheix Safety Working Group", "The Yudcheix Safety Working Group", "Yudcheix Saf. Working Group", "YUDCHEIX Safety Working Group"]


def test_variants_meet_and_people_stay_apart(spark):
    entries = [*JANA, *MIN_HO, *BECKY, *GROUP, "Yudcheix Language Team", "Paulo Dikcison", "et al.", "others", "…", "", " ", "12", None]
    assert pairs(spark, entries) == all_pairs(JANA, MIN_HO, BECKY, GROUP)


def test_slipped_surname_with_many_readings(spark):
    people = ["Dewi V.", "Jennifer", "Andre T.", "Noor F.", "Rafael", "Zuzana", "Kenji P.", "Leila"]
    some = ["Dewi V.", "Jennifer", "Andre T.", "Noor F."]
    right, slipped, other = "Quaevzao", "Quaezvao", "Quaevzam"
    entries = [f"{g} {right}" for g in people] + [f"{g} {slipped}" for g in some]
    apart = [f"{g} {other}" for g in ("Minho", "Bilal", "Gabor", "Linh", "Rafael")]  # another surname, one given name in common
    got = pairs(spark, entries + apart)
    assert got == all_pairs(*[(f"{g} {right}", f"{g} {slipped}") for g in some])
    cores = [(s, g, i) for s, g, i in [(right, "dewi", "dv"), (right, "noor", "nf"), (slipped, "", "dv"), (slipped, "", "nf"), (slipped, "dewi", "dv"), (slipped, "noor", "nf"), (other, "", "b"), (other, "gabor", "g"), (other, "linh", "l"), (other, "", "m")]]
    table = spark.createDataFrame([(k, "person", *c) for k, c in enumerate(cores)], "core bigint, kind string, surname string, given string, initials string")
    near = spark.createDataFrame([(right, slipped), (other, right)], "surname_a string, surname_b string")
    judged = {(r.surname_a, r.surname_b): (r.by_given, r.by_initials) for r in N.slipped_surnames(table, near).collect()}
    assert judged[right, slipped] == (True, True) and not any(judged.get((other, right), (False,)))


def test_order_is_learned_from_certain_entries(spark):
    certain = [f"Rafael K. {s}" for s in ("Aldomir", "Bostrand", "Cevlin")] + ["Griarskit, R."]
    got = pairs(spark, [*certain, "Griarskit Rafael", "Rafael Griarskit"])
    assert got == all_pairs(["Griarskit Rafael", "Griarskit, R.", "Rafael Griarskit"])


def test_one_edit_against_brute_force():
    rng = random.Random(1)

    def brute(a, b):
        out = {a}
        for i in range(len(a) + 1):
            out |= {a[:i] + c + a[i:] for c in "abc"} | {a[:i] + a[i + 1 :]} | {a[:i] + c + a[i + 1 :] for c in "abc" if i < len(a)}
            if i + 1 < len(a):
                out.add(a[:i] + a[i + 1] + a[i] + a[i + 2 :])
        return b in out

    for _ in range(4000):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 6))) for _ in "ab")
        assert N.one_edit(a, b) == brute(a, b), (a, b)


def test_average_linkage_against_brute_force():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.randrange(2, 9)
        sim = {(i, j): rng.choice([0.0, 0.2, 0.45, 0.6, 0.9]) + rng.random() * 0.01 for i, j in itertools.combinations(range(n), 2)}
        links = [(i, j, s) for (i, j), s in sim.items() if s > 0.1]
        got = N.average_linkage(links, 0.3)
        clusters = [{i} for i in range(n)]
        w = {frozenset(k): s if s > 0.1 else 0.0 for k, s in sim.items()}
        while True:
            best = max(((sum(w[frozenset((x, y))] for x in a for y in b) / len(a) / len(b), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j), default=(0, 0, 0))
            if best[0] < 0.3:
                break
            clusters[best[1]] |= clusters.pop(best[2])
        want = {frozenset(c) for c in clusters if len(c) > 1}
        made = {}
        for x, c in got.items():
            made.setdefault(c, set()).add(x)
        assert {frozenset(c) for c in made.values() if len(c) > 1} == want


def test_large_components_are_taken_apart(spark):
    df = spark.createDataFrame([(e,) for e in JANA + MIN_HO], "name string")
    whole = {r.name: r.set_id for r in N.spelling_sets(df).collect()}
    small = {r.name: r.set_id for r in N.spelling_sets(df, most_links=1).collect()}
    assert set(whole) == set(small)
    assert all(small[a] != small[b] or whole[a] == whole[b] for a in whole for b in whole)


def test_rounds_equal_average_linkage(spark):
    rng = random.Random(6)
    links = [(100 * k + i, 100 * k + j, rng.random()) for k in range(6) for i, j in itertools.combinations(range(9), 2) if rng.random() < 0.7]
    df = spark.createDataFrame(links, "a bigint, b bigint, cosine double")
    assert {r.core: r.set_id for r in N.merged_in_rounds(df, 0.3).collect()} == N.average_linkage(links, 0.3)
    names = spark.createDataFrame([(e,) for e in JANA + MIN_HO + BECKY], "name string")
    sets = [{r.name: r.set_id for r in N.spelling_sets(names, most_links=n).collect()} for n in (1, 200_000)]
    assert sets[0] == sets[1]


def test_empty(spark):
    assert pairs(spark, []) == [] and pairs(spark, ["…", "others"]) == []
    a = spark.createDataFrame([(["x y", None],), (None,)], "authors array<string>")
    assert [r.name for r in N.entries((a, "authors"), (a, "authors")).collect()] == ["x y"]


def test_the_cosine_tells_given_names_apart(spark):
    """Without the threshold (the exact check alone) other given names of one surname would be linked."""
    people = [(1, "person", "kovarik", "jana", "j"), (2, "person", "kovarik", "jitka", "j"), (3, "person", "kovarik", "", "j"), (4, "person", "kovarik", "janna", "j"), (5, "person", "kovarik", "bob", "b"), (6, "person", "kovarik", "robert", "r")]
    cores = spark.createDataFrame(people, "core bigint, kind string, surname string, given string, initials string")
    found = lambda t: {(r.a, r.b): r.cosine for r in N.spelling_links(cores, t).collect()}
    kept, all_ = found(N.THRESHOLD), found(0.0)
    assert set(kept) == {(1, 3), (1, 4), (2, 3), (3, 4), (5, 6)} and {(1, 2), (2, 4)} <= set(all_) - set(kept)
    assert max(all_[1, 2], all_[2, 4]) < N.THRESHOLD < min(kept.values())


def test_cosine_of_parts_is_that_of_the_outer_product():
    readings = [("person", "smith", "anna", "ab"), ("person", "smyth", "ann", "a"), ("person", "smith", "", "a")]
    vectors = [N.name_vector(*r, {}) for r in readings]

    def outer(v):
        s, i, g = v
        given = {**i, **{k: w * N.GIVEN**0.5 for k, w in g.items()}}
        return {(x, y): a * b for x, a in s.items() for y, b in given.items()}

    for x in vectors:
        for y in vectors:
            p, q = outer(x), outer(y)
            plain = sum(w * q.get(k, 0) for k, w in p.items()) / (sum(w * w for w in p.values()) * sum(w * w for w in q.values())) ** 0.5
            assert abs(N.name_cosine(x, y) - plain) < 1e-9


def test_long_posting_lists_lose_no_link(spark):
    given = ["anna", "anne", "annika", "antonia", "agnes", "agneta", "alma", "albert", "alberta", "arno"]
    people = [("person", s, g, i) for s in ("berglund", "bergland") for g in given for i in ("a", "ab", "ac")] + [("person", "berglund", "", i) for i in ("a", "ab", "b")]
    cores = spark.createDataFrame([(n, *p) for n, p in enumerate(people)], "core bigint, kind string, surname string, given string, initials string")
    pairs = lambda hot: {(r.a, r.b) for r in N.posting_pairs(cores, hot).collect()}
    usual, split = pairs(10_000), pairs(2)
    vectors = {n: N.name_vector(*p, {}) for n, p in enumerate(people)}
    lost = {(a, b) for a, b in usual - split if N.name_cosine(vectors[a], vectors[b]) >= N.THRESHOLD}
    assert split <= usual and len(split) < len(usual) and not lost
