"""Rules for the JSON that a model answers with: messages of what is wrong, and typed values of answers that are right.

Answers are read as variants, so that a number is no text and a text no number. A message names the field.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T

# Names that the contracts fix (fixed values).
THOUGHT_KINDS = ("H", "ALT", "?", "PIVOT", "INSIGHT", "ERR-R")
THOUGHT_SOURCES = ("thinking", "narration", "inferred")
ARC_KINDS = ("H", "ALT", "PIVOT", "INSIGHT", "ERR-R")
ARC_STATUSES = ("confirmed", "refuted", "open", "noticed", "never")
OUTCOMES = ("success", "partial", "failure")
POLARITIES = ("strategy", "guardrail")
CHECKPOINT = ("intent", "concepts", "files", "errors", "pending", "current", "next", "critical")

BLOCK = "anchor struct<fromLine bigint, toLine bigint>, action string, thoughts array<struct<kind string, source string, text string, q string>>, factsClaimed struct<checks struct<run bigint, failed bigint>, exitCode bigint>, fallback boolean"
DIGEST = f"goal string, openHypotheses array<struct<text string, q string>>, currentBelief string, naming array<string>, checkpoint struct<{', '.join(f'{c} string' for c in CHECKPOINT)}>"
ANALYSIS = (
    "arcs array<struct<kind string, text string, status string, fromLine bigint, toLine bigint, subject string>>, verdict struct<status string, why string>, "
    "items array<struct<title string, description string, content string, polarity string, subject array<string>, evidence array<struct<line bigint>>>>"
)


def kind_of(value: Column, path: str) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT and so on; VOID for null and for what isn't there."""
    name = F.schema_of_variant(F.try_variant_get(value, f"$.{path}", "variant") if path else value)
    return F.coalesce(F.regexp_extract(name, r"^\w+", 0), F.lit("VOID"))


def text_at(value: Column, path: str) -> Column:
    return F.when(kind_of(value, path) == "STRING", F.try_variant_get(value, f"$.{path}", "string"))


def whole_at(value: Column, path: str) -> Column:
    return F.when(kind_of(value, path) == "BIGINT", F.try_variant_get(value, f"$.{path}", "bigint"))


def list_at(value: Column, path: str) -> Column:
    """The elements of an array, or null."""
    return F.try_variant_get(value, f"$.{path}", "array<variant>")


def messages(tests: Iterable[tuple[Column, Column | str]]) -> Column:
    """The messages of the tests that hold; an unknown test doesn't."""
    return F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), F.lit(m) if isinstance(m, str) else m) for bad, m in tests)))


def _each(items: Column, name: str, tests) -> Column:
    """Messages of all elements, with their places."""
    at = lambda i: F.format_string(f"{name}[%d]", i)
    found = F.flatten(F.transform(items, lambda x, i: messages((bad, F.concat(at(i), F.lit(f".{m}"))) for bad, m in tests(x))))
    return F.coalesce(found, F.array().cast("array<string>"))


def _texts(value: Column, limits: dict[str, int | None]) -> list[tuple[Column, str]]:
    out = []
    for path, most in limits.items():
        out.append((text_at(value, path).isNull(), f"{path} missing"))
        if most:
            out.append((T.text_units(text_at(value, path)) > most, f"{path} too long"))
    return out


def _whole_object(value: Column, found: Column) -> Column:
    return F.when(kind_of(value, "").eqNullSafe("OBJECT"), found).otherwise(F.array(F.lit("no JSON object")))


def block_errors(value: Column, from_line: Column, to_line: Column, quote_ids: Column | None = None) -> Column:
    """Messages about a compressed turn (a variant) over lines from_line to to_line; its thoughts may cite quote_ids, if given."""
    first, last = whole_at(value, "anchor.fromLine"), whole_at(value, "anchor.toLine")
    anchor = kind_of(value, "anchor") == "OBJECT"

    def thought(t: Column) -> list[tuple[Column, str]]:
        kind, source, q = text_at(t, "kind"), text_at(t, "source"), text_at(t, "q")
        cites = source.isin("thinking", "narration")
        known = F.lit(True) if quote_ids is None else F.array_contains(quote_ids, q)
        return [
            (~F.coalesce(kind.isin(*THOUGHT_KINDS), F.lit(False)), "kind unknown"), (~F.coalesce(source.isin(*THOUGHT_SOURCES), F.lit(False)), "source unknown"), *_texts(t, {"text": 400}),
            (cites & q.isNull(), "q missing"), (cites & ~known, "q is no quote of the turn"), ((source == "inferred") & ~kind.isin("H", "?"), "kind must be H or ? if inferred"),
        ]

    single = F.when(kind_of(value, "thought") == "OBJECT", F.array(F.try_variant_get(value, "$.thought", "variant")))
    own = messages([
        (~anchor, "anchor missing"), (anchor & first.isNull(), "anchor.fromLine is no integer"), (anchor & last.isNull(), "anchor.toLine is no integer"), ((first < from_line) | (first > to_line), "anchor.fromLine outside the turn"),
        (last < first, "anchor.toLine before anchor.fromLine"), (last > to_line + 2, "anchor.toLine beyond the turn"), *_texts(value, {"action": 400}), (~kind_of(value, "thought").isin("VOID", "OBJECT"), "thought is no object"),
        (~kind_of(value, "thoughts").isin("VOID", "ARRAY"), "thoughts is no array"), (~kind_of(value, "factsClaimed").isin("VOID", "OBJECT"), "factsClaimed is no object"),
    ])
    return _whole_object(value, F.concat(own, _each(single, "thought", thought), _each(list_at(value, "thoughts"), "thoughts", thought)))


def digest_errors(value: Column) -> Column:
    """Messages about a digest that carries one window into the next."""
    points = kind_of(value, "checkpoint")
    own = messages([*_texts(value, {"goal": 300}), (kind_of(value, "openHypotheses") != "ARRAY", "openHypotheses is no array"), *_texts(value, {"currentBelief": None}), (~points.isin("VOID", "OBJECT"), "checkpoint is no object")])
    held = messages(t for c in CHECKPOINT for t in ((~kind_of(value, f"checkpoint.{c}").isin("VOID", "STRING"), f"checkpoint.{c} is no text"), (T.text_units(text_at(value, f"checkpoint.{c}")) > 600, f"checkpoint.{c} too long")))
    return _whole_object(value, F.concat(own, _each(list_at(value, "openHypotheses"), "openHypotheses", lambda h: _texts(h, {"text": None})), held))


def analysis_errors(value: Column, parity: bool = False) -> Column:
    """Messages about the analysis of a session; unless ``parity``, more than three items are an error too."""
    one_of = lambda v, path, names: (~F.coalesce(text_at(v, path).isin(*names), F.lit(False)), f"{path} unknown")
    arc = lambda a: [one_of(a, "kind", ARC_KINDS), one_of(a, "status", ARC_STATUSES), *_texts(a, {"text": None}), (whole_at(a, "fromLine").isNull(), "fromLine is no integer")]
    item = lambda i: [*_texts(i, {"title": None, "description": None, "content": None}), one_of(i, "polarity", POLARITIES), *((kind_of(i, c) != "ARRAY", f"{c} is no array") for c in ("subject", "evidence"))]
    arcs, items = list_at(value, "arcs"), list_at(value, "items")
    own = messages([(arcs.isNull(), "arcs is no array"), one_of(value, "verdict.status", OUTCOMES), *_texts(value, {"verdict.why": None}), (items.isNull(), "items is no array"), *([] if parity else [(F.size(items) > 3, "more than three items")])])
    return _whole_object(value, F.concat(own, _each(arcs, "arcs", arc), _each(items, "items", item)))


def as_block(body: Column) -> Column:
    """A right block's JSON text as a struct."""
    return F.from_json(body, BLOCK)


def as_digest(body: Column) -> Column:
    """A right digest's JSON text as a struct; parts of a checkpoint that aren't there are empty."""
    made = F.from_json(body, DIGEST)
    held = F.struct(*(F.coalesce(made["checkpoint"][c], F.lit("")).alias(c) for c in CHECKPOINT))
    return F.when(made.isNotNull(), made.withField("checkpoint", F.when(made["checkpoint"].isNotNull(), held)))


def as_analysis(body: Column) -> Column:
    """A right analysis' JSON text as a struct; items without subjects or evidence have empty lists."""
    made = F.from_json(body, ANALYSIS)
    filled = lambda i: i.withField("subject", F.coalesce(i["subject"], F.array().cast("array<string>"))).withField("evidence", F.coalesce(i["evidence"], F.array().cast("array<struct<line:bigint>>")))
    return F.when(made.isNotNull(), made.withField("items", F.transform(made["items"], filled)))
