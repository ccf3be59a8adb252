"""Scalar functions on tool calls and their outputs: families, signatures, diffs, test summaries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Families in the order in which their patterns are tried (fixed values).
FAMILIES = (
    ("read", r"(^|__)(read|view|cat|list|ls)$"),
    ("search", "grep|glob|search|find|ls|dirlist|toolsearch"),
    ("edit", "edit|write|patch|apply_patch|multiedit|notebookedit|create_file|str_replace"),
    ("execute", "bash|shell|exec|terminal|command|run"),
    ("web", "webfetch|websearch|fetch|browser"),
    ("agent", "task|agent|spawn|subagent"),
    ("mcp", "^mcp__"),
)


def classify_tool(name: Column) -> Column:
    low = F.lower(name)
    ladder = None
    for family, pattern in FAMILIES:
        ladder = F.when(low.rlike(pattern), family) if ladder is None else ladder.when(low.rlike(pattern), family)
    return ladder.otherwise("other")


def _string(record: Column, *keys: str) -> Column:
    """The first of the keys that is there; a string or empty."""
    return F.coalesce(*(F.get_json_object(record, f"$.{k}") for k in keys), F.lit(""))


def tool_signature(name: Column, record: Column) -> Column:
    """The arguments that matter of a call's JSON input."""
    path = _string(record, "file_path", "path", "notebook_path")
    off, lim = (F.try_to_number(F.get_json_object(record, f"$.{k}"), F.lit("999999999999")).cast("bigint") for k in ("offset", "limit"))
    ranged = F.when(off.isNotNull() & lim.isNotNull(), F.format_string("%s:%d-%d", path, off, off + lim)).otherwise(path)
    raw = F.get_json_object(record, "$.command")
    command = F.when(F.startswith(raw, F.lit("[")), F.array_join(F.from_json(raw, "array<string>"), " ")).otherwise(F.coalesce(raw, F.lit("")))
    where = F.get_json_object(record, "$.path")
    keys = F.json_object_keys(record)
    values = F.transform(keys, lambda k: F.get(F.map_values(F.from_json(record, "map<string,string>")), F.array_position(F.map_keys(F.from_json(record, "map<string,string>")), k).cast("int") - F.lit(1)))
    quoted = F.filter(values, lambda v: F.length(v) > 0)
    first = F.left(F.coalesce(F.get(quoted, F.lit(0)), F.lit("")), F.lit(80))
    return (
        F.when(record.isNull(), "").when(F.left(F.ltrim(record), F.lit(1)) != "{", F.left(record, F.lit(100)))
        .when(name.isin("Read", "Write", "Edit", "MultiEdit", "NotebookEdit"), ranged)
        .when(name == "Bash", command)
        .when(name == "Grep", F.concat(_string(record, "pattern"), F.when(where.isNotNull() & (where != ""), F.concat(F.lit(" in "), where)).otherwise("")))
        .when(name == "Glob", _string(record, "pattern"))
        .when(name.isin("WebFetch", "WebSearch"), _string(record, "url", "query"))
        .when(name.isin("Task", "Agent"), _string(record, "description", "prompt"))
        .when(name == "ToolSearch", _string(record, "query"))
        .when(raw.isNotNull(), command).otherwise(first)
    )


def call_key(name: Column, signature: Column) -> Column:
    return F.concat_ws("::", name, signature)


def edit_diff(name: Column, record: Column) -> Column:
    """struct<added, removed, file_path> of an edit call: the net change of lines, which can be negative."""
    path = F.nullif(_string(record, "file_path", "path", "notebook_path"), F.lit(""))
    edits = F.from_json(F.get_json_object(record, "$.edits"), "array<struct<old_string:string,new_string:string>>")

    def lines(key: str) -> Column:
        own = F.get_json_object(record, f"$.{key}")
        every = F.concat(F.when(own.isNull(), F.array().cast("array<string>")).otherwise(F.array(own)), F.coalesce(F.transform(edits, lambda e: e[key]), F.array().cast("array<string>")))
        return F.size(F.split(F.array_join(F.array_compact(every), "\n"), "\n", -1))

    content = _string(record, "content", "new_str")
    made = lambda n: F.struct(n.cast("bigint").alias("added"), F.lit(0).cast("bigint").alias("removed"), path.alias("file_path"))
    return F.when(name.isin("Edit", "MultiEdit"), made(lines("new_string") - lines("old_string"))).when(name.isin("Write", "create_file", "str_replace_based_edit_tool") & (content != ""), made(F.size(F.split(content, "\n", -1))))


def patch_diff(patch: Column) -> Column:
    """struct<added, removed, file_path> of a patch text; the last file that it updates or adds names it."""
    lines = F.split(patch, "\n", -1)
    body = F.filter(lines, lambda x: ~x.rlike(r"^(\*\*\*|\+\+\+|---|@@|\[)"))
    files = F.transform(F.filter(lines, lambda x: x.rlike(r"^\*\*\* (Update|Add) File: ")), lambda x: F.trim(F.regexp_replace(x, r"^\*\*\* (Update|Add) File: ", "")))
    count = lambda sign: F.size(F.filter(body, lambda x: F.startswith(x, F.lit(sign)))).cast("bigint")
    out = F.struct(count("+").alias("added"), count("-").alias("removed"), F.get(files, F.size(files) - F.lit(1)).alias("file_path"))
    return F.when((count("+") > 0) | (count("-") > 0), out)


def strip_exec_header(output: Column) -> Column:
    """The body behind the header of a command's output."""
    at = F.instr(output, "\nOutput")
    return F.when(at > 0, F.substr(output, at + F.lit(8))).otherwise(output)


def exit_code(output: Column) -> Column:
    return F.regexp_extract(output, r"Process exited with code (-?\d+)", 1).try_cast("int")


def _most(values: Column) -> Column:
    return F.coalesce(F.array_max(values), F.lit(0))


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


SUMMARY = r"(?i)Tests?:\s*(?:(\d+)\s*failed)?\s*\|?\s*(?:(\d+)\s*passed)?"
COUNT = r"(\d+)\s+(passed|failed)"
RESULT = r"test result:\s*\w+\.\s*(\d+) passed;\s*(\d+) failed"


def detect_checks(output: Column) -> Column:
    """struct<run, failed, failed_names> of a test runner's summary in an output, or null. Only numbers and
    listed failures count. Outputs without any of the words cost one search; take the struct as a column before its fields are used."""
    number = lambda text, pattern, group: F.coalesce(F.regexp_extract(text, pattern, group).try_cast("int"), F.lit(0))
    every = lambda t, pattern: F.regexp_extract_all(t, F.lit(pattern), F.lit(0))

    def found(t: Column) -> Column:
        return F.struct(
            F.transform(every(t, SUMMARY), lambda m: F.struct(number(m, SUMMARY, 1).alias("f"), number(m, SUMMARY, 2).alias("p"))).alias("first"),
            F.transform(every(t, COUNT), lambda m: F.struct(number(m, COUNT, 1).alias("n"), F.regexp_extract(m, COUNT, 2).alias("k"))).alias("second"),
            F.transform(every(t, RESULT), lambda m: F.struct(number(m, RESULT, 1).alias("p"), number(m, RESULT, 2).alias("f"))).alias("third"),
            F.regexp_extract_all(t, F.lit(r"--- FAIL:\s*(\S+)"), F.lit(1)).alias("listed"),
            F.array_distinct(F.filter(F.regexp_extract_all(t, F.lit(r"(?m)^\s*(?:FAIL|FAILED)\s+(.+?)\s*$"), F.lit(1)), lambda x: F.length(F.trim(x)) > 0)).alias("named"),
        )

    def counted(x: Column) -> Column:
        first, run = x["first"], _most(F.transform(x["first"], lambda m: m["f"] + m["p"]))
        single = F.aggregate(x["second"], F.lit(0), lambda a, m: a + m["n"])
        worst = _most(F.transform(F.filter(x["second"], lambda m: m["k"] == "failed"), lambda m: m["n"]))
        failed = F.greatest(_most(F.transform(first, lambda m: m["f"])), F.when(run == 0, worst).otherwise(F.lit(0)), _most(F.transform(x["third"], lambda m: m["f"])))
        more = F.size(x["listed"])
        extra = F.slice(F.array_except(x["named"], x["listed"]), F.lit(1), F.greatest(F.lit(0), F.lit(5) - more))
        return F.struct(
            F.greatest(F.when(run == 0, single).otherwise(run), _most(F.transform(x["third"], lambda m: m["f"] + m["p"]))).cast("bigint").alias("run"),
            F.when(more > 0, F.greatest(failed, F.lit(1)) + more - F.lit(1)).otherwise(failed).cast("bigint").alias("failed"), F.concat(x["listed"], extra).alias("failed_names"),
        )

    made = _let(_let(_let(F.right(output, F.lit(8000)), found), counted), lambda c: F.when((c["run"] > 0) | (c["failed"] > 0) | (F.size(c["failed_names"]) > 0), c))
    return F.when(output.rlike("(?i)test|passed|failed|FAIL"), made)


def extract_path(signature: Column) -> Column:
    """The path of a signature without its line range."""
    return F.regexp_replace(signature, r":\d+-\d+$", "")
