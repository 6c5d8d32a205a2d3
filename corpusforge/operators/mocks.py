"""Text models that answer by rule: the answer follows from the hash of the prompt, so results can be compared.

Their answers have the shapes, old names and flaws that answers of real models have: JSON in
prose, fields under other names, scalars where lists belong, blanks, and no JSON at all.
"""

from __future__ import annotations

import hashlib
import json
import re

_LISTED = re.compile(r"\d+\. ")


def _digits(text: str) -> str:
    return hashlib.sha1(text.encode()).hexdigest()


def _listed(prompt: str) -> list[str]:
    return [line for line in prompt.split("\n") if _LISTED.match(line)]


def label_model(prompt: str) -> str:
    """A label, a score and a reason."""
    h = hashlib.sha1(prompt.encode()).digest()
    return f'Here you are: {{"label": "{("positive", "hard_negative", "ignored")[h[0] % 3]}", "score": {h[1] % 5 + 1}, "reason": "r{h[2]}"}} Done.'


def review_model(prompt: str) -> str:
    """A verdict on a candidate; one in four is no known label."""
    h = _digits(prompt)
    label = ("positive", " Hard_Negative ", "ignored", "unsure")[int(h[0], 16) % 4]
    return f'Verdict: {json.dumps({"label": label, "reason": f" r{h[1:4]} "})}.'


def list_model(prompt: str) -> str:
    """A score for every numbered line, in the order listed."""
    scores = [hashlib.sha1(x.encode()).digest()[1] % 5 + 1 for x in _listed(prompt)]
    return f'Here you are: {json.dumps({"results": [{"score": s} for s in scores]})} Done.'


def keyword_model(prompt: str) -> str:
    """The words of the last line as an array with a blank in it; for a prompt hash of 0 modulo 4 no array."""
    words = prompt.split("\n")[-1].split()
    return "None found." if int(_digits(prompt)[0], 16) % 4 == 0 else f"Keywords: {json.dumps([*words[:1], ' ', *words[1:7]])}"


def summary_model(prompt: str, views: tuple[str, ...]) -> str:
    """An object with some of the views, each in one of three shapes; no object for a first digit of 0."""
    h = _digits(prompt)
    if h[0] == "0":
        return f"No summary {h}"
    out: dict[str, object] = {}
    for i, view in enumerate(views):
        key = view.replace("/", "_").replace(" ", "_")
        shape = int(h[i + 1], 16) % 4
        if shape == 1:
            out[key] = [f"b{h[5:8]}", "  ", {"text": " c "}]
        elif shape == 2:
            out[key] = {"summary": f" s{h[8:11]} ", "bullet_points": [{"bullet_point": f"x{h[11:14]}", "sources": "R1"}, {"content": ""}]}
        elif shape == 3:
            out[view] = {"summary": "", "bullet_points": [{"text": "t", "source_refs": ["a", " ", "b"]}, {"content": "u"}]}
    return f"Sure. {json.dumps(out)} Done."


def query_model(prompt: str) -> str:
    """An object of lists of queries, as objects and as plain text; no object for a first digit of 0."""
    h = _digits(prompt)
    if h[0] == "0":
        return f"none {h}"
    first = [
        {"query_text": f"q{h[1:4]} (multimodal)", "related_bullet_indices": ["0", "2"]},
        {"Q": f" z{h[4:7]} ", "is_multimodal": True, "justification": "j"},
        f"plain (multimodal) {h[7:9]}",
        {"query_text": "  "},
    ]
    return f'Here: {json.dumps({"contribution": first, "method/dataset": {"not": "a list"}, "limitation/scope": [f"w{h[9:12]}"]})}'


def retrieval_model(prompt: str) -> str:
    """A verdict for every numbered line; the last is left out where a third of them divides evenly."""
    lines = _listed(prompt)
    verdicts = [("PASS", " pass ", "FAIL", "maybe", None)[int(_digits(x)[0], 16) % 5] for x in lines]
    items = [{"query": x, "dimensions": {"full_paper_reliance": v} if v else {}, "reasoning": f" {_digits(x)[1:4]} "} for x, v in zip(lines, verdicts)]
    return f"Verdicts: {json.dumps(items[:-1] if len(items) % 3 == 0 else items)}"


def style_model(prompt: str) -> str:
    """Two scores, some outside the scale, and a count, some below zero, for every numbered line."""
    items = []
    for line in _listed(prompt):
        h = _digits(line)
        items.append({
            "metric_1_specificity_calibration": {"score": int(h[0], 16) % 7, "rationale": f" {h[3:6]} "},
            "metric_2_lexical_naturalism": {"score": str(int(h[1], 16) % 6)},
            "metric_3_semantic_constraint_count": {"count": int(h[2], 16) - 4},
        })
    return f'Scores: {json.dumps({"results": items})}'
