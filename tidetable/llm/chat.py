"""Chat records of different layouts as canonical turns, and turns as text with a loss mask.

A record is a JSON text. Its layout is known by a fingerprint: the hash of its nested field paths, whatever the values
and their types. Each fingerprint selects a declarative mapping, a list of rules that say which path gives which turns,
so a new layout is a new entry and no new code. Records whose fingerprint no mapping has get no turns (null).

`formatted` writes turns with control strings around them and escapes every character that can begin one inside
roles and texts; `read_back` undoes both. The loss mask is kept as segments of the text, each in or out of it; the
segments joined are the text. Null texts and roles are empty. Everything is column expressions.

The JSON functions hold texts of at most 20,000,000 characters and records of at most 128 MB. `records_of` therefore hands on
conversations beyond `LONG_TEXT` or `LONG_RECORD` as typed rows together with the paths of their layout, and they are mapped by the same
fingerprint. A JSON record from elsewhere beyond these limits has no fingerprint and no turns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

TURN, END = "<|turn|>", "<|end|>"
TURNS = "array<struct<role:string,text:string>>"
LONG_TEXT, LONG_RECORD = 10_000_000, 50_000_000


@dataclass(frozen=True)
class One:
    """A path that holds the text of one turn."""

    role: str
    path: str


@dataclass(frozen=True)
class Many:
    """A path that holds a list of turns, each with a role and a text; ``roles`` renames roles."""

    path: str
    role: str
    text: str
    roles: tuple[tuple[str, str], ...] = ()


_NAMES = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))

#: Field paths of a layout and the rules that give its turns in order.
LAYOUTS: dict[tuple[str, ...], tuple[One | Many, ...]] = {
    ("messages", "messages[].content", "messages[].role"): (Many("messages", "role", "content"),),
    ("conversations", "conversations[].from", "conversations[].value"): (Many("conversations", "from", "value", _NAMES),),
    ("turns", "turns[].role", "turns[].text"): (Many("turns", "role", "text"),),
    ("completion", "prompt"): (One("user", "prompt"), One("assistant", "completion")),
    ("prompt", "response"): (One("user", "prompt"), One("assistant", "response")),
    ("instruction", "output"): (One("user", "instruction"), One("assistant", "output")),
    ("instruction", "output", "system"): (One("system", "system"), One("user", "instruction"), One("assistant", "output")),
    ("instruction", "input", "output"): (One("user", "instruction"), One("user", "input"), One("assistant", "output")),
}


def field_paths(record: str) -> Column:
    """Nested field paths of a JSON record as a sorted list: ``a``, ``a.b`` in objects, ``a[].b`` in lists.

    Read from the record's inferred schema, level by level down to lists of objects, so types and values leave no trace.
    """
    schema = F.schema_of_variant(F.try_parse_json(record))
    # scalars away: what stays is names, and brackets for objects and lists
    bare = F.regexp_replace(schema, r"(?<=: |ARRAY<)(?!OBJECT<|ARRAY<)[A-Z][A-Z0-9(),_ ]*(?=[,>])", "-")
    top = F.regexp_extract_all(F.regexp_replace(bare, r"^OBJECT<|>$", ""), F.lit(r"(\w+): (ARRAY<(?:OBJECT<[^<>]*>|-)>|OBJECT<[^<>]*>|-)"), F.lit(0))

    def below(entry: Column) -> Column:
        name = F.regexp_extract(entry, r"^(\w+):", 1)
        inner = F.regexp_extract_all(F.regexp_extract(entry, r"OBJECT<([^<>]*)>", 1), F.lit(r"(\w+): "), F.lit(1))
        link = F.when(entry.contains(": ARRAY<"), "[].").otherwise(".")
        return F.concat(F.array(name), F.transform(inner, lambda x: F.concat(name, link, x)))

    return F.array_sort(F.flatten(F.transform(top, below)))


def fingerprint(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "\n"))


def _turn(role: Column, text: Column) -> Column:
    empty = F.lit("")
    return F.struct(F.coalesce(role, empty).alias("role"), F.coalesce(text, empty).alias("text"))


def _rule(record: Column, rule: One | Many) -> Column:
    if isinstance(rule, One):
        return F.array(_turn(F.lit(rule.role), F.try_variant_get(record, f"$.{rule.path}", "string")))
    listed = F.try_variant_get(record, f"$.{rule.path}", f"array<struct<`{rule.role}`:string,`{rule.text}`:string>>")

    def one(item: Column) -> Column:
        role = item[rule.role]
        for given, meant in rule.roles:
            role = F.when(item[rule.role] == given, meant).otherwise(role)
        return _turn(role, item[rule.text])

    return F.transform(listed, one)


def _of_rows(rows: Column, rules: Sequence[One | Many]) -> Column:
    """Typed turns under the names that the rules give roles."""
    renamed = {given: meant for rule in rules if isinstance(rule, Many) for given, meant in rule.roles}

    def one(row: Column) -> Column:
        role = row["role"]
        for given, meant in renamed.items():
            role = F.when(row["role"] == given, meant).otherwise(role)
        return _turn(role, row["text"])

    return F.transform(rows, one)


def canonical(records: DataFrame, record: str = "record", paths: str | None = None, rows: str | None = None) -> DataFrame:
    """``records`` with ``fingerprint`` and ``turns``, null where no mapping has the fingerprint.

    Where ``rows`` (turns as structs of role and text) is not null it stands in for the JSON record, ``paths`` naming its
    layout's field paths.
    """
    marked = records.withColumn("__paths", field_paths(record)).withColumn("__record", F.try_parse_json(record))
    typed = F.lit(None).cast(TURNS) if rows is None else F.col(rows)
    if paths is not None:
        marked = marked.withColumn("__paths", F.when(typed.isNotNull(), F.array_sort(paths)).otherwise(F.col("__paths")))
    marked = marked.withColumn("fingerprint", fingerprint(F.col("__paths")))
    turns = F.lit(None).cast(TURNS)
    for names, rules in LAYOUTS.items():
        known = fingerprint(F.array(*map(F.lit, sorted(names))))
        mapped = F.concat(*[_rule(F.col("__record"), r) for r in rules])
        if rows is not None:
            mapped = F.when(typed.isNotNull(), _of_rows(typed, rules)).otherwise(mapped)
        turns = F.when(F.col("fingerprint") == known, mapped).otherwise(turns)
    return marked.withColumn("turns", turns).drop("__paths", "__record")


def escaped(text: Column) -> Column:
    """No character that begins a control string, neither ours nor those of other templates, is left."""
    return F.replace(F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l")), F.lit("["), F.lit("\\b"))


def unescaped(text: Column) -> Column:
    parts = F.split(text, r"\\\\")  # pairs of backslashes, which stand for one
    return F.array_join(
        F.transform(parts, lambda x: F.replace(F.replace(x, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("["))), "\\"
    )


def formatted(turns: DataFrame, column: str = "turns", trained: Sequence[str] = ("assistant",)) -> DataFrame:
    """``turns`` with ``formatted`` and ``segments``: stretches of it with whether they count in the loss."""

    def written(turn: Column) -> Column:
        # a role ends at the first line end, so its own are escaped as well
        role = F.replace(escaped(turn["role"]), F.lit("\n"), F.lit("\\n"))
        return F.array(
            F.struct(F.concat(F.lit(TURN), role, F.lit("\n")).alias("text"), F.lit(False).alias("loss")),
            F.struct(escaped(turn["text"]).alias("text"), turn["role"].isin(*trained).alias("loss")),
            F.struct(F.lit(END + "\n").alias("text"), F.lit(False).alias("loss")),
        )

    segments = turns.withColumn("segments", F.flatten(F.transform(column, written)))
    return segments.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_back(text: str = "formatted") -> Column:
    """The turns of a formatted text."""

    def turn(part: Column) -> Column:
        at = F.instr(part, "\n")  # the role is short: the text behind it is taken from there on
        role = F.substring(part, F.lit(1), at - 1)
        body = F.substring(part, at + 1, F.length(part) - at - len(END) - 1)
        names = F.split(role, r"\\\\")
        role = F.array_join(F.transform(names, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\\\")
        return F.struct(unescaped(role).alias("role"), unescaped(body).alias("text"))

    parts = F.split(text, TURN.replace("|", r"\|"))
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def loss_text(segments: str = "segments") -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescaped(s["text"])), "")


def records_of(conversations: DataFrame) -> DataFrame:
    """Rows of turns as one record per conversation: ``conv_id, record, paths, rows``.

    A record is a JSON text; that of a conversation too long for JSON is null, and its turns are in ``rows``, its layout's
    paths in ``paths``. Turns are ordered by number, those without one first, equal ones by role and text. Two and three turns of the usual
    roles become prompt and instruction records, all others message lists.
    """
    empty = F.lit("")
    row = F.struct(
        "turn",
        F.coalesce(F.col("role").cast("string"), empty).alias("role"),
        F.coalesce(F.col("text").cast("string"), empty).alias("content"),
    )
    held = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    turns = F.col("turns")
    roles = F.array_join(F.transform(turns, lambda t: F.replace(t["role"], F.lit(","), F.lit(";"))), ",")
    text = lambda i: F.get(turns, F.lit(i))["content"]
    messages = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("content")))
    record = (
        F.when(roles == "user,assistant", F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("completion"))))
        .when(
            roles == "system,user,assistant",
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("instruction"), text(2).alias("output"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    longest = F.array_max(F.transform(turns, lambda t: F.length(t["content"]) + F.length(t["role"])))
    whole = F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + F.octet_length(t["content"]) + F.octet_length(t["role"]))
    too_long = (longest > LONG_TEXT) | (whole > LONG_RECORD)
    named = lambda *names: F.array(*map(F.lit, names))
    paths = F.when(roles == "user,assistant", named("prompt", "completion"))
    paths = paths.when(roles == "system,user,assistant", named("system", "instruction", "output"))
    paths = paths.otherwise(named("messages", "messages[].content", "messages[].role"))
    typed = F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["content"].alias("text")))
    return held.select(
        "conv_id",
        F.when(~too_long, record).alias("record"),
        F.when(too_long, paths).alias("paths"),
        F.when(too_long, typed).alias("rows"),
    )


def digests(written: DataFrame) -> DataFrame:
    """What `formatted` wrote, read back: one row per conversation."""
    back = written.select("conv_id", read_back().alias("turns"), loss_text().alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
