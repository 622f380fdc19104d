"""Text and JSON columns: labelled sections of captions, prompts, verdicts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The section labels of a caption, those that describe a whole room, and how a section says none.
LABELS = ("SCENE", "MEDIUM", "VIEW", "LAYOUT", "OBJECTS", "LIGHTING", "PALETTE", "TEXT", "INVARIANTS")
ROOM_WIDE = ("SCENE", "MEDIUM", "LIGHTING", "PALETTE", "TEXT")
SAYS_NONE = ("none", "no text", "absent", "no legible text")
#: Fixed value: what in the MEDIUM section speaks of a rendered picture.
RENDERED = r"(?i)pre-?rendered|\b3d\b|\bcgi\b|computer[- ]generated"

_LABEL = r"^[ \t]*[*_#]*[ \t]*(?:%s)[ \t]*[*_]*[ \t]*:[*_]*"


def normalized(text: Column) -> Column:
    """Without blanks at the ends of lines and line breaks at the end of the text."""
    return F.regexp_replace(F.regexp_replace(text, r"(?m)[ \t]+$", ""), r"\n+$", "")


def section(caption: Column, label: str) -> Column:
    """What the first section of that label holds, stripped; null if there is none or nothing in it."""
    body = F.regexp_extract(caption, rf"(?ms){_LABEL % label}(.*?)(?={_LABEL % '|'.join(LABELS)}|\z)", 1)
    return F.nullif(F.regexp_replace(body, r"^\s+|\s+$", ""), F.lit(""))


def room_wide(caption: Column) -> Column:
    """The sections that describe the whole room, as LABEL: text lines in a fixed order; the caption if it has none."""
    lines = [F.concat(F.lit(f"{label}: "), section(caption, label)) for label in ROOM_WIDE]
    return F.coalesce(F.nullif(F.concat_ws("\n", *lines), F.lit("")), caption)


def lettering(caption: Column) -> Column:
    """The TEXT section, null if it says that there is none."""
    text = section(caption, "TEXT")
    return F.when(~F.regexp_replace(F.lower(text), r"\.+$", "").isin(*SAYS_NONE), text)


def style(caption: Column) -> Column:
    return F.when(F.coalesce(section(caption, "MEDIUM"), F.lit("")).rlike(RENDERED), "rendered").otherwise("painted")


@dataclass(frozen=True)
class Wording:
    """The texts that a prompt is put together from; {reference} and {text} are filled in."""

    painted: str
    rendered: str
    insert: str
    insert_text: str
    observations: str
    corrections: str
    closing: str
    reference: str = "the provided reference image"
    painted_negative: str = ""
    rendered_negative: str = ""


def prompt(caption: Column, kind: Column, corrections: Column, note: Column, of_style: Column, w: Wording) -> Column:
    """Rules of the style, those of an insert, the note, the caption, corrections and the closing, with blank lines between."""
    rules = F.when(of_style == "rendered", w.rendered.replace("{reference}", w.reference)).otherwise(w.painted.replace("{reference}", w.reference))
    text = lettering(caption)
    insert = F.when(kind == "insert", F.when(text.isNotNull(), F.replace(F.lit(w.insert_text), F.lit("{text}"), text)).otherwise(w.insert))
    said = F.when(F.size(corrections) > 0, F.concat(F.lit(w.corrections + "\n"), F.array_join(corrections, "\n")))
    return F.concat_ws("\n\n", rules, insert, F.nullif(note, F.lit("")), F.concat(F.lit(w.observations + "\n"), caption), said, F.lit(w.closing))


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, halves to the even number."""
    return F.concat(F.bround(100.0 * part / whole, 0).cast("int").cast("string"), F.lit("%"))


def window_note(x0: Column, x1: Column, left: Column, right: Column) -> Column:
    """Where a window lies within its room's width; null if it covers all of it."""
    width = right - left
    said = F.concat(F.lit("from "), percent(x0 - left, width), F.lit(" to "), percent(x1 - left, width), F.lit(" of the room's width"))
    return F.when((x0 != left) | (x1 != right), said)


def json_text(answer: Column, required: str) -> Column:
    """The JSON object in an answer: the first fenced block that has the key, or from the first { to the last }."""
    blocks = F.transform(F.regexp_extract_all(answer, F.lit(r"(?s)```(?:json)?(.*?)```"), F.lit(1)), lambda b: F.regexp_replace(b, r"^\s+|\s+$", ""))
    fenced = F.get(F.filter(blocks, lambda b: F.array_contains(F.coalesce(F.json_object_keys(b), F.array().cast("array<string>")), required)), F.lit(0))
    return F.coalesce(fenced, F.nullif(F.regexp_extract(answer, r"(?s)(\{.*\})", 1), F.lit("")), answer)


VERDICT = "struct<accepted:boolean,issues:array<string>>"


def valid_verdict(v: Column) -> Column:
    """Whether a verdict has its boolean, issues that say something, and accepts exactly without issues."""
    issues = v["issues"]
    return F.coalesce(v["accepted"].isNotNull() & issues.isNotNull() & F.forall(issues, lambda i: i.isNotNull() & (F.trim(i) != "")) & (v["accepted"] == (F.size(issues) == 0)), F.lit(False))


def verdict(answer: Column) -> Column:
    """The verdict in an answer; null if it is not valid."""
    v = F.from_json(json_text(answer, "accepted"), VERDICT)
    return F.when(valid_verdict(v), v)


def object_verdicts(answer: Column, asked: Column) -> Column:
    """map of the valid verdicts on the objects that were asked about; all others are left out."""
    found = F.from_json(json_text(answer, "objects"), f"struct<objects:map<string,{VERDICT}>>")["objects"]
    return F.map_filter(F.coalesce(found, F.create_map().cast(f"map<string,{VERDICT}>")), lambda k, v: F.array_contains(asked, k) & valid_verdict(v))


def plan_line(name: Column, kind: Column, windows: Column, wrap: Column, attempt: Column) -> Column:
    """One line of a plan: what is said only where it applies, joined by semicolons."""
    extra = F.concat_ws("; ", F.when(windows > 1, F.concat(windows.cast("string"), F.lit(" windows"))), F.when(wrap.isNotNull(), F.concat(F.lit("wraps at "), wrap.cast("string"))), F.when(attempt > 1, F.concat(F.lit("attempt "), attempt.cast("string"))))
    return F.concat(F.rpad(name, F.greatest(F.lit(12), F.length(name)), F.lit(" ")), kind, F.when(extra != "", F.concat(F.lit(" ("), extra, F.lit(")"))).otherwise(""))


def negative(of_style: Column, w: Wording) -> Column:
    """What a prompt of a style is to keep away from."""
    return F.when(of_style == "rendered", w.rendered_negative).otherwise(w.painted_negative)


def timestamp_text(at: Column) -> Column:
    """A time in UTC, to the second: 2001-02-03T04:05:06Z."""
    return F.date_format(F.to_utc_timestamp(at, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def review_question(question: str, rules: dict[str, str], windows: Column, kind: Column, of_style: Column, caption: Column) -> Column:
    """What a critic is asked about a room: the question with the rule of its style, and what the room is.

    The lettering of an insert is expected as its caption has it; nothing is expected of others.
    """
    known = F.create_map(*[F.lit(x) for kv in rules.items() for x in kv])
    rule = F.coalesce(F.element_at(known, of_style), F.lit(rules["painted"]))
    expected = F.coalesce(F.when(kind == "insert", lettering(caption)), F.lit("none"))
    facts = F.concat_ws(" ", F.concat(F.lit("Windows: "), windows.cast("string"), F.lit(".")), F.concat(F.lit("Kind: "), kind, F.lit(".")), F.concat(F.lit("Style: "), F.coalesce(F.nullif(of_style, F.lit("")), F.lit("painted")), F.lit(".")), F.concat(F.lit("Lettering: "), expected, F.lit(".")))
    return F.concat(F.replace(F.lit(question), F.lit("{style_rule}"), rule), F.lit("\n"), facts)
