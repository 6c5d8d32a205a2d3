"""Which question template a query follows: the first of an ordered list of patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusforge.functions.text import strip

# Patterns, tried in this order on the lower-case query, and the names of their templates.
_PAPER, _WHAT, _GIVE = "Is there a paper/method that/which...", "What [open-source/latest/first] method...", "Give me papers [that/on/about]..."
TEMPLATES: list[tuple[str, str]] = [
    (r"^is there (a |any )?(paper|work|method|model|dataset|tool|study|approach|technique|system|decoder-|knowledge graph|vision-language|backdoor|multimodal|audio|video|numerical reasoning)?( that | which | )?", _PAPER),
    (r"^is there any (paper|work|method|model|dataset|tool|study|approach|technique|system) ", _PAPER),
    (r"^is there such a? (paper|work|method|model|dataset|tool|study|approach|technique|system)?( that | which | )?", _PAPER),
    (r"^are there (any |)?(([a-z0-9-]+ )*)benchmark papers? ", _PAPER),
    (r"^are there (any |)?(([a-z0-9-]+ )*)(benchmark|benchmarks|dataset|datasets|study|studies|paper|papers|work|works|method|methods|model|models|approach|approaches) ", _PAPER),
    (r"^are there (any |)?(sequential |papers? |methods? |models? |approaches? )", _PAPER),
    (r"^are there any papers? (that |which |on |about )?", _PAPER),
    (r"^any papers? (on |about |regarding |that |which )?", _PAPER),
    (r"^which (([a-z0-9-]+ )*)(paper|papers|study|studies|benchmark|benchmarks|dataset|datasets|method|methods|model|models|work|works)( first |proposes |introduces |presents |shows |finds |found |uses |is |are |was |were |about |on |)", _WHAT),
    (r"^which paper(s| research| vision-language| backdoor| numerical| knowledge graph|)?( first |proposes |introduces |presents |is | |about |on |)", _WHAT),
    (r"^which (is |are |was |were |)?the (first |)?", _WHAT),
    (r"^which (knowledge graph|vision-language|multimodal|backdoor|audio|video|benchmark|study|method|model|approach|work|dataset|technique|system|decoder|numerical reasoning|numeral|paper|papers|research) (first |proposes |introduces |presents |shows |finds |found |uses |is |was |focuses |developed |can |published |)", _WHAT),
    (r"^which numerical reasoning paper", _WHAT),
    (r"^what('s| is| are| was| were|') ", _WHAT),
    (r"^what (open-source |latest |recent )?(([a-z0-9-]+ )*)(paper|work|method|model|dataset|benchmark|study|papers|studies|benchmarks|datasets) ", _WHAT),
    (r"^what (limitations|ability|capabilities) (do|does|are|is)? ?", _WHAT),
    (r"^give me (all |any |some |)?papers? (that |which |on |about |showing |demonstrating |)", _GIVE),
    (r"^give me all (visual |)?(LLM|model|papers?|multimodal |)", _GIVE),
    (r"^show me (all |some |cutting edge |)?(research |papers? |studies? |work |)", _GIVE),
    (r"^show me (research |papers? |studies? |work ) (on |about |regarding )?", _GIVE),
    (r"^provide (me with |)(all |any )?papers? ", _GIVE),
    (r"^provide (me with |)(all |any )?(papers?|research|studies) ", _GIVE),
    (r"^list (all |any )?papers? ", _GIVE),
    (r"^find (me |all |any )?papers? ", _GIVE),
    (r"^all papers (on |about |regarding |)", _GIVE),
    (r"^papers? (that |which |on |about |proposing |presenting |introducing )?", _GIVE),
    (r"^research (on |about |regarding )?", _GIVE),
    (r"^search for (papers? |research |)", _GIVE),
    (r"^how to ", "How to [achieve/do]..."),
    (r"^how does ", "How does [X work]..."),
    (r"^how do ", "How do [X work]..."),
    (r"^how can ", "How can [we/X]..."),
    (r"^why ", "Why [does/is X]..."),
    (r"^can ", "Can [we/X]..."),
    (r"^can i ", "Can I..."),
    (r"^could ", "Could [we/X]..."),
    (r"^help me (search |find |)", "Help me search/find..."),
    (r"^i am looking for ", "I am looking for..."),
    (r"^i need (papers? |research |studies? ) (on |about |regarding )?", "I need papers on/about..."),
    (r"^i would like (to |)", "I would like to..."),
    (r"^using ", "Using [X for Y]..."),
    (r"^does ", "Does [X work/affect]..."),
    (r"^do ", "Do [X/they]..."),
    (r"^if one (would like |wants |)", "If one would like/wants..."),
    (r"^who ", "Who [proposed/first]..."),
    (r"^when ", "When [was X proposed]..."),
    (r"^where ", "Where [is X from]..."),
    (r"^papers?( on| about| regarding| using| with| for)", "Papers [on/about]..."),
    (r"^[A-Z][a-z]+( [A-Z][a-z]+)+", "Paper title/name format"),
]
OTHER = "other"


def template_rank(query: Column, templates: list[tuple[str, str]] = TEMPLATES) -> Column:
    """Place of the first pattern that matches; null if none does or the query is null. First match ends the test."""
    text = F.lower(strip(query))
    out = None
    for i, (pattern, _) in enumerate(templates):
        hit = text.rlike(pattern)
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return out


def template_name(rank: Column, templates: list[tuple[str, str]] = TEMPLATES) -> Column:
    names = F.array(*[F.lit(name) for _, name in templates])
    return F.coalesce(F.get(names, rank), F.lit(OTHER))


def template_pattern(rank: Column, templates: list[tuple[str, str]] = TEMPLATES) -> Column:
    return F.coalesce(F.get(F.array(*[F.lit(p) for p, _ in templates]), rank), F.lit(OTHER))
