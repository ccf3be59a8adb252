"""Scalar text functions as Columns: truncation, references, hashes, slugs, formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as the log producers' runtime counts it; Java's own class is ASCII only.
BLANK = r"[\s   -     　﻿]"
#: Words at the end of an output that move the kept share towards the tail (fixed values).
TROUBLE = r"(?i)\b(error|exception|failed|fatal|traceback|panic|exit code|errno|denied)\b"
LONG_LINE = 2000


def text_units(text: Column) -> Column:
    """Length in UTF-16 units."""
    return (F.octet_length(F.encode(text, "UTF-16BE")) / F.lit(2)).cast("int")


def estimate_tokens(text: Column) -> Column:
    """A quarter of the length, rounded up."""
    return F.ceil(text_units(text) / F.lit(4.0)).cast("bigint")


def trimmed(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{BLANK}+|{BLANK}+$", "")


def squashed(text: Column) -> Column:
    """White space runs as one space, none at the ends."""
    return F.btrim(F.regexp_replace(text, rf"{BLANK}+", " "))


def cap_line(text: Column, cap: int) -> Column:
    one = squashed(text)
    return F.when(F.length(one) <= cap, one).otherwise(F.concat(F.substring(one, 1, max(0, cap - 1)), F.lit("…")))


def first_line(text: Column, cap: int = 160) -> Column:
    return cap_line(F.substring_index(text, "\n", 1), cap)


def head_tail(text: Column, head: int, tail: int = 0, marker: Column | None = None) -> Column:
    """The first ``head`` and last ``tail`` characters; the marker tells what is gone."""
    gone = F.length(text) - F.lit(head + tail)
    mark = F.format_string("…[%d chars dropped]…", gone) if marker is None else marker
    end = F.right(text, F.lit(tail)) if tail else F.lit("")
    return F.when(F.length(text) <= head + tail, text).otherwise(F.concat(F.left(text, F.lit(head)), mark, end))


def cap_block(text: Column, most: int) -> Column:
    """A multi-line text cut at ``most`` characters, at a line end if one lies in the second half."""
    whole = trimmed(text)
    cut = F.left(whole, F.lit(most))
    last = F.length(cut) - F.instr(F.reverse(cut), "\n")  # 0-based; -1 position shows as the length
    at_line = (F.instr(cut, "\n") > 0) & (last > most * 0.5)
    kept = F.when(at_line, F.substr(cut, F.lit(1), last)).otherwise(cut)
    return F.when(F.length(whole) <= most, whole).otherwise(F.concat(kept, F.format_string("\n…[+%d chars]", F.length(whole) - F.length(kept))))


def plural(n: Column, one: str, many: str) -> Column:
    return F.concat_ws(" ", n.cast("string"), F.when(n == 1, one).otherwise(many))


def inline_code(text: Column, cap: int = 100) -> Column:
    return F.concat(F.lit("`"), F.translate(cap_line(text, cap), "`", "'"), F.lit("`"))


def cap_long_lines(text: Column, most: int = LONG_LINE) -> Column:
    """Lines of a multi-line text cut at ``most`` characters each."""
    one = lambda x: F.when(F.length(x) > most, F.concat(F.left(x, F.lit(most)), F.format_string("…[+%d chars]", F.length(x) - F.lit(most)))).otherwise(x)
    return F.when(F.contains(text, F.lit("\n")), F.array_join(F.transform(F.split(text, "\n"), one), "\n")).otherwise(text)


def _let(value: Column, body) -> Column:
    """body(value), with value evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def truncate_centered(text: Column, head: int, tail: int = 0, anchor: Column | None = None, sha: Column | None = None) -> Column:
    """The middle of a long text replaced by a marker inside the budget; more of the end stays if it tells of trouble.

    Cuts move to close line ends, truncated text passes unchanged, and what would not shrink stays whole.
    """
    total = head + tail
    suffix = F.concat(F.lit(" chars"), *([F.format_string(" @L%d", anchor)] if anchor is not None else []), *([F.concat(F.lit(", sha:#"), sha)] if sha is not None else []), F.lit("⟩"))
    mark = lambda size, kept: F.concat(F.format_string("…⟨truncated: %d→%d", size, kept), suffix)
    least = min(head, 1 if tail else total)

    def measured(t: Column) -> Column:
        share = F.when(F.right(t, F.lit(2048)).rlike(TROUBLE), F.lit(0.3)).otherwise(F.lit(0.7))
        return F.struct(t.alias("text"), F.length(t).alias("size"), share.alias("share"), (F.lit(total) - F.length(mark(F.length(t), F.lit(total)))).alias("room"))

    def split(m: Column) -> Column:
        first = F.floor(m["room"] * m["share"]).cast("int")
        return F.struct(m.alias("m"), first.alias("head"), (m["room"] - first).alias("tail"), cap_long_lines(F.left(m["text"], first)).alias("begin"), (cap_long_lines(F.substr(m["text"], m["size"] - (m["room"] - first) + F.lit(1), m["room"] - first)) if tail else F.lit("")).alias("end"))

    def snapped(s: Column) -> Column:
        line = F.length(s["begin"]) - F.instr(F.reverse(s["begin"]), "\n")
        begin = F.when((F.instr(s["begin"], "\n") > 0) & (line > s["head"] * 0.5), F.left(s["m"]["text"], line + F.lit(1))).otherwise(s["begin"])
        at = F.instr(s["end"], "\n")
        end = F.when((at > 0) & (at - F.lit(1) < s["tail"] * 0.5), F.substr(s["end"], at + F.lit(1))).otherwise(s["end"])
        return F.struct(s["m"].alias("m"), begin.alias("begin"), end.alias("end"))

    def joined(p: Column) -> Column:
        whole = F.concat(p["begin"], mark(p["m"]["size"], F.length(p["begin"]) + F.length(p["end"])), p["end"])
        return F.when(F.length(whole) >= p["m"]["size"], p["m"]["text"]).otherwise(whole)

    def cut(m: Column) -> Column:
        tight = F.concat(F.left(m["text"], F.greatest(F.lit(8), m["room"])), mark(m["size"], F.lit(total)))
        return F.when(m["room"] < least, tight).otherwise(_let(_let(_let(m, split), snapped), joined))

    return F.when(F.startswith(text, F.lit("…⟨truncated:")) | (F.length(text) <= total), text).otherwise(_let(_let(text, measured), cut))


def ref_tag(line: Column) -> Column:
    return F.format_string("@L%d", line)


def ref_range(first: Column, last: Column) -> Column:
    return F.when(first == last, ref_tag(first)).otherwise(F.format_string("@L%d–L%d", first, last))


def short_hash(text: Column) -> Column:
    return F.substring(F.sha2(F.encode(text, "UTF-8"), 256), 1, 8)


def format_bytes(n: Column) -> Column:
    kilo = F.lit(1024.0)
    return F.when(n < 1024, F.format_string("%dB", n)).when(n < 1024 * 1024, F.format_string("%.1fkB", n / kilo)).otherwise(F.format_string("%.1fMB", n / kilo / kilo))


def tombstone(size: Column, lines: Column, digest: Column, line: Column) -> Column:
    return F.concat(F.lit("…⟨"), format_bytes(size), F.format_string(", %d ln, #", lines), digest, F.format_string(", @L%d⟩", line))


def _units(text: Column) -> Column:
    """UTF-16 units of a text: one for each code point, two for those beyond the basic plane."""
    points = F.transform(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)), lambda c: F.ascii(c).cast("bigint"))
    over = lambda c: c - F.lit(65536)
    pair = lambda c: F.array(F.lit(0xD800).cast("bigint") + F.floor(over(c) / F.lit(1024)), F.lit(0xDC00).cast("bigint") + F.pmod(over(c), F.lit(1024)))
    return F.flatten(F.transform(points, lambda c: F.when(c < F.lit(65536), F.array(c)).otherwise(pair(c))))


def quote_id(text: Column) -> Column:
    """q and six hexadecimal digits of the 32-bit FNV-1a over the UTF-16 units of the squashed text."""
    fold = F.aggregate(_units(squashed(text)), F.lit(2166136261).cast("bigint"), lambda h, c: (h.bitwiseXOR(c) * F.lit(16777619)).bitwiseAND(F.lit(4294967295)))
    return F.concat(F.lit("q"), F.substring(F.lpad(F.lower(F.hex(fold)), 8, "0"), 1, 6))


def slice_hash(text: Column) -> Column:
    """Two 32-bit lanes over the UTF-16 units of the text, in hexadecimal without padding."""
    mask = F.lit(4294967295)
    numbered = F.transform(_units(text), lambda c, i: F.struct(c.alias("c"), (i + F.lit(1)).cast("bigint").alias("i")))
    start = F.struct(F.lit(0x811C9DC5).cast("bigint").alias("a"), F.lit(0x1000193).cast("bigint").alias("b"))

    def step(s: Column, x: Column) -> Column:
        a = (s["a"].bitwiseXOR(x["c"]) * F.lit(16777619)).bitwiseAND(mask)
        y = (s["b"] + x["c"] * x["i"]).bitwiseAND(mask)
        # y * 0x85ebca6b in two halves, so that no product leaves 64 bits
        b = (y * F.lit(51819) + (y * F.lit(34283)).bitwiseAND(F.lit(65535)) * F.lit(65536)).bitwiseAND(mask)
        return F.struct(a.alias("a"), b.alias("b"))

    return F.aggregate(numbered, start, step, lambda s: F.lower(F.concat(F.hex(s["a"]), F.hex(s["b"]))))


def slugify(text: Column, cap: int = 40) -> Column:
    dashed = F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
    cut = F.rtrim(F.left(dashed, F.lit(cap)), F.lit("-"))
    return F.when(F.length(cut) > 0, cut).otherwise(F.lit("session"))


def trace_file_name(started: Column, ids: Column, title: Column) -> Column:
    """<date>-<ids>-<slug>.md of an array of session ids in order."""
    shown = F.array_join(F.transform(F.slice(ids, 1, 3), lambda i: F.left(i, F.lit(8))), "+")
    more = F.when(F.size(ids) > 3, "+etc").otherwise("")
    return F.concat(F.left(F.coalesce(started, F.lit("1970-01-01")), F.lit(10)), F.lit("-"), shown, more, F.lit("-"), slugify(F.coalesce(title, F.lit("session"))), F.lit(".md"))


def session_key(path: Column) -> Column:
    return F.substring(F.sha2(F.encode(path, "UTF-8"), 256), 1, 16)


def project_slug(path: Column) -> Column:
    return slugify(F.element_at(F.split(F.rtrim(path, F.lit("/")), "/"), -1), 50)


def count_lines(text: Column) -> Column:
    """Lines; a line end at the very end opens no further one."""
    body = F.regexp_replace(text, r"\n$", "")
    return F.when(text == "", F.lit(0)).otherwise(F.size(F.split(body, "\n", -1)))


def display_name(tool: Column) -> Column:
    """mcp__server__tool as mcp:server/tool."""
    return F.when(F.startswith(tool, F.lit("mcp__")), F.concat(F.lit("mcp:"), F.replace(F.substr(tool, F.lit(6)), F.lit("__"), F.lit("/")))).otherwise(tool)


def strip_refs(text: Column) -> Column:
    """References without their line numbers, and no repeat count at the end."""
    return F.regexp_replace(F.regexp_replace(text, r"@L\d+(–L\d+)?", "@L"), r"(?s)^(.+?) ×\d+$", "$1")


def normalize_title(text: Column) -> Column:
    return squashed(F.lower(text))


def hhmm(stamp: Column, seconds: bool = False) -> Column:
    """Clock time of an ISO text in the session's zone; ??:?? if it is none."""
    at = F.try_to_timestamp(stamp)
    return F.coalesce(F.date_format(at, "HH:mm:ss" if seconds else "HH:mm"), F.lit("??:??"))


def fmt_duration(ms: Column) -> Column:
    """Seconds below a minute, then minutes and the seconds that are left, if any."""
    whole = lambda x: F.floor(x / F.lit(1000.0) + F.lit(0.5)).cast("bigint")
    rest = whole(ms % 60_000)
    minutes = F.format_string("%dm", F.floor(ms / F.lit(60_000)))
    return F.when(ms < 60_000, F.format_string("%ds", whole(ms))).otherwise(F.concat(minutes, F.when(rest > 0, F.format_string(" %ds", rest)).otherwise("")))


def fmt_number(n: Column) -> Column:
    """Below 1000 as it is, then one decimal of thousands, from 100 thousand on whole ones."""
    k = n / F.lit(1000.0)
    return F.when(n < 1000, n.cast("string")).when(n < 100_000, F.format_string("%.1fk", k)).otherwise(F.format_string("%dk", F.floor(k + F.lit(0.5)).cast("bigint")))


def iso_from_millis(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms.cast("bigint")), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def rounded(x: Column, digits: int) -> Column:
    """Half up, also for negative numbers."""
    return F.floor(x * F.lit(10.0**digits) + F.lit(0.5)) / F.lit(10.0**digits)


def compression_ratio(log_bytes: Column, trace_tokens: Column) -> Column:
    return F.when(trace_tokens == 0, F.lit(0.0)).otherwise(rounded(F.ceil(log_bytes / F.lit(4.0)) / trace_tokens, 1))


def extract_json_object(text: Column) -> Column:
    """The JSON object in a model's answer: a fenced block if it parses, else what lies between the outermost braces."""
    fenced = trimmed(F.regexp_extract(text, r"(?s)```(?:json)?\s*\n?(.*?)```", 1))
    braces = F.regexp_extract(text, r"(?s)\{.*\}", 0)
    good = lambda x: F.when((F.left(F.ltrim(x), F.lit(1)) == "{") & F.try_parse_json(x).isNotNull(), x)
    return F.coalesce(good(fenced), good(braces))


def strip_envelopes(text: Column, tags: tuple[str, ...] = ("system-reminder", "background-task-finished")) -> Column:
    """Leading machine envelopes <tag>...</tag> removed, again and again."""
    one = "|".join(f"<{t}>.*?</{t}>" for t in tags)
    return F.regexp_replace(text, rf"(?s)^\s*(?:(?:{one})\s*)+", "")


def substitute_refs(text: Column, names: Column) -> Column:
    """Paths replaced by their file ids; ``names`` array<struct<path, id>>, longest path first."""
    ordered = F.array_sort(names, lambda a, b: F.when(F.length(a["path"]) > F.length(b["path"]), -1).when(F.length(a["path"]) < F.length(b["path"]), 1).when(a["path"] < b["path"], -1).when(a["path"] > b["path"], 1).otherwise(0))
    return F.aggregate(ordered, text, lambda t, n: F.replace(t, n["path"], n["id"]))


def repo_bound(markdown: Column, project: str | None = None, home: str = "/root") -> Column:
    """A trace that can leave the machine: no log references, no absolute paths of the project or of homes."""
    s = F.regexp_replace(markdown, r"…⟨truncated, full text @L\d+⟩", "…⟨truncated⟩")
    for pattern in (r"(?m)^- s1 @L → .*$", r"(?m)^> `@L<n>`.*$\n", r"(?m)^\s*logFile: .*$", r" ?@L\d+(?:(?:–|→|-\|?)L\d+)?", r" ?@L(?=\W|\b)", r"(?m)^## Trace Recovery$(?:\n(?!## )[\s\S]*)?"):
        s = F.regexp_replace(s, pattern, "")
    s = F.regexp_replace(F.regexp_replace(s, ",⟨", " ⟨"), ", ?⟩", "⟩")
    if project:
        s = F.replace(F.replace(s, F.lit(project.rstrip("/") + "/"), F.lit("")), F.lit(project.rstrip("/")), F.lit("."))
    if len(home.rstrip("/")) > 1:
        s = F.replace(s, F.lit(home.rstrip("/")), F.lit("~"))
    s = F.regexp_replace(s, r"/(?:Users|home)/[^/\s`'\"()⟨⟩]*", "~")
    return F.regexp_replace(s, r"\n{3,}", "\n\n")


def clean_user_text(text: Column) -> Column:
    """What a person typed in a prompt's text: without reminders, caveats and decoration lines; null if nothing is left or it
    is a command's output."""
    bare = F.regexp_replace(text, r"(?s)<system-reminder>.*?</system-reminder>|<local-command-caveat>.*?</local-command-caveat>", "")
    lines = F.filter(F.split(bare, "\n", -1), lambda x: ~x.rlike(r"^\s*[✻※❯⏺⎿●✳✶✽]\s"))
    kept = trimmed(F.array_join(lines, "\n"))
    noise = F.startswith(text, F.lit("Caveat: The messages below")) | (kept == "") | F.startswith(kept, F.lit("<local-command-stdout>"))
    return F.when(~noise, kept)
