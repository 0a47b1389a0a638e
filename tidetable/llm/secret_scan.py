"""Secrets in texts, and weak parts of credentials that count only together.

Three kinds are certain enough alone: assignments to a secret's name, access keys and long hexadecimal runs. Other
parts are weak: names of accounts, mixed tokens, service addresses. They are linked by an interval join over scopes:
a text is cut into blocks of ``SCOPE`` code points, and two parts share a scope if they begin in the same or in
neighbouring blocks. A weak part is reported only with what completes it: an account with a secret, a mixed token
with an account, an address with both. Parts found by themselves complete weak ones, too.

Everything is column expressions over whole texts; no row leaves its task, and the time is linear in the text. Positions are
code points, the end exclusive. A null text is empty and has no spans; repeated rows give repeated results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidetable.llm.shared import text_of

SCOPE = 256
PART = 512
STRETCH = 8192  # code points of a text that are redacted at once
REDACTED = "[REDACTED]"

# fixed values: the three kinds found alone, in the order of their rank
_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS = r"AKIA[A-Z0-9]{12,}"
_HEX = r"[0-9a-f]{32,}"
# weak parts
_ACCOUNT = r"""(?i:access_?key_?id|client_?id|account|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
_MIXED = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
_ADDRESS = r"""(?i:https?|ftp|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+"""

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


_STEPS = "array<struct<gap:int,size:int,wanted:boolean>>"


def _parts(items: str) -> Column:
    """An array cut into arrays of ``PART`` items, so that what grows inside one stays small."""
    last = F.shiftright(F.greatest(F.size(items) - 1, F.lit(0)), PART.bit_length() - 1)
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(F.col(items), i * PART + 1, F.lit(PART)))


def _steps(text: Column, pattern: str, long_enough: tuple[int, int] | None = None, holding: tuple[str, ...] = ()) -> Column:
    """Leftmost non-overlapping matches: the lengths of the stretch before each and of the match, and whether it counts.

    ``long_enough`` names a group and its least length, ``holding`` what has to be found in a match. The stretch behind
    the last match is a step without one.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    stated = F.regexp_extract_all(text, F.lit(pattern), F.lit(long_enough[0])) if long_enough else matches

    def measured(step: Column) -> Column:
        wanted = step["hit"].isNotNull()
        if long_enough:
            wanted &= F.length(step["part"]) >= long_enough[1]
        for held in holding:
            wanted &= step["hit"].rlike(held)
        size = F.coalesce(F.length(step["hit"]), F.lit(0))
        return F.struct(F.length(step["gap"]).alias("gap"), size.alias("size"), F.coalesce(wanted, F.lit(False)).alias("wanted"))

    steps = F.arrays_zip(F.split(text, pattern).alias("gap"), matches.alias("hit"), stated.alias("part"))
    return F.when(text.rlike(pattern), F.transform(steps, measured)).otherwise(F.array().cast(_STEPS))


def _begins(parts: str) -> Column:
    """Where each part of the steps begins: the lengths of the parts in front of it."""

    def begin(done: Column, part: Column) -> Column:
        length = F.aggregate(part, F.lit(0), lambda n, step: n + step["gap"] + step["size"])
        return F.struct((done["at"] + length).alias("at"), F.concat(done["held"], F.array(done["at"])).alias("held"))

    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("held"))
    return F.aggregate(parts, zero, begin, lambda done: done["held"])


def _spans(parts: str, begins: str, kind: str, rank: int) -> Column:
    """The steps that count as spans, placed by adding up lengths within their part."""

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + step["gap"]
        end = start + step["size"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))
        held = F.when(step["wanted"], F.concat(done["held"], F.array(span))).otherwise(done["held"])
        return F.struct(end.alias("at"), held.alias("held"))

    none = F.array().cast(_SPAN)

    def within(part: Column) -> Column:
        return F.aggregate(part["steps"], F.struct(part["at"].alias("at"), none.alias("held")), add, lambda done: done["held"])

    return F.flatten(F.transform(F.arrays_zip(F.col(parts).alias("steps"), F.col(begins).alias("at")), within))


def _block(span: Column) -> Column:
    return F.floor(span["start"] / SCOPE)


def _blocks(*spans: str) -> Column:
    """Blocks of a text in which any of these parts begin."""
    return F.array_distinct(F.transform(F.concat(*spans), _block))


def _near(spans: str, *blocks: str) -> Column:
    """The spans that have one of each of these blocks as their own or a neighbour.

    A part of the spans looks only at the blocks between its first and its last one.
    """

    def bound(value: Column, use) -> Column:
        """``use(value)`` with the value computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def matched(part: Column, around: Column) -> Column:
        def hit(span: Column) -> Column:
            block = _block(span)
            return F.array_contains(around, block) | F.array_contains(around, block - 1) | F.array_contains(around, block + 1)

        return F.filter(part, hit)

    def beside(name: str):
        """A part's spans beside the blocks that lie between its own first and last one."""

        def few(part: Column) -> Column:
            ends = F.struct((_block(F.get(part, F.lit(0))) - 1).alias("low"), (_block(F.element_at(part, -1)) + 1).alias("high"))
            around = bound(ends, lambda e: F.filter(name, lambda b: (b >= e["low"]) & (b <= e["high"])))
            return F.when(F.size(part) > 0, bound(around, lambda held: matched(part, held))).otherwise(part)

        return few

    def within(part: Column) -> Column:
        for name in blocks:
            part = bound(part, beside(name))
        return part

    return F.when(F.size(spans) > 0, F.flatten(F.transform(_parts(spans), within))).otherwise(F.array().cast(_SPAN))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``__base`` and ``__linked``: the spans found alone, and the weak ones that others complete."""
    given = docs.withColumn("__text", text_of(text))
    body = F.col("__text")
    steps = {
        "assign": _steps(body, _ASSIGN, long_enough=(2, 8)),
        "access": _steps(body, _ACCESS),
        "hex": _steps(body, _HEX),
        "account": _steps(body, _ACCOUNT),
        "mixed": _steps(body, _MIXED, holding=("[0-9]", "[A-Za-z]")),
        "address": _steps(body, _ADDRESS),
    }
    # step by step in selections of their own, so that nothing is computed twice
    measured = given.select("*", *[made.alias(f"__steps_{kind}") for kind, made in steps.items()])
    cut = measured.select(*docs.columns, "__text", *[_parts(f"__steps_{kind}").alias(f"__parts_{kind}") for kind in steps])
    begun = cut.select("*", *[_begins(f"__parts_{kind}").alias(f"__begins_{kind}") for kind in steps])
    found = begun.select(
        *docs.columns,
        "__text",
        *[_spans(f"__parts_{kind}", f"__begins_{kind}", kind, rank).alias(f"__{kind}") for rank, kind in enumerate(steps)],
    )
    placed = found.select(
        "*",
        _blocks("__account", "__access").alias("__ids_in"),
        _blocks("__assign", "__hex", "__mixed").alias("__secrets_in"),
    )
    linked = F.concat(
        _near("__account", "__secrets_in"),
        _near("__mixed", "__ids_in"),
        _near("__address", "__ids_in", "__secrets_in"),
    )
    return placed.select(
        *docs.columns,
        "__text",
        F.size("__assign").cast("long").alias("__n_assign"),
        F.size("__access").cast("long").alias("__n_access"),
        F.size("__hex").cast("long").alias("__n_hex"),
        F.array_sort(F.concat("__assign", "__access", "__hex")).alias("__base"),
        linked.alias("__linked"),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``."""
    found = scan(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__given")), "__given")
    return found.select(
        "doc_id",
        F.col("__n_assign").alias("n_assign"),
        F.col("__n_access").alias("n_access"),
        F.col("__n_hex").alias("n_hex"),
        F.sha2(_listed(F.col("__base")), 256).alias("base_sha256"),
        _listed(F.array_sort(F.concat("__base", "__linked"))).alias("spans"),
    )


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by a mark; spans that overlap get one. Texts without spans stay, null too."""
    found = scan(docs, text).withColumn("__all", F.array_sort(F.concat("__base", "__linked")))
    found = found.withColumn("__cut", F.when(F.size("__all") > 0, F.regexp_extract_all("__text", F.lit(f"(?s).{{1,{STRETCH}}}"), F.lit(0))))

    def clean(stretch: Column, number: Column) -> Column:
        low = number * STRETCH
        high = low + F.length(stretch)

        def add(done: Column, span: Column) -> Column:
            before = F.substring(stretch, done["at"] - low + 1, span["start"] - done["at"])
            fresh = (span["start"] >= low) & (span["start"] >= done["at"])
            out = F.when(fresh, F.concat(done["out"], before, F.lit(REDACTED))).otherwise(done["out"])
            return F.struct(F.greatest(done["at"], span["end"]).alias("at"), out.alias("out"))

        def rest(done: Column) -> Column:
            at = F.least(done["at"], high)
            return F.concat(done["out"], F.substring(stretch, at - low + 1, high - at))

        own = F.filter("__all", lambda s: (s["start"] < high) & (s["end"] > low))
        return F.aggregate(own, F.struct(low.alias("at"), F.lit("").alias("out")), add, rest)

    changed = F.array_join(F.transform("__cut", clean), "")
    result = F.when(F.size("__all") > 0, changed).otherwise(F.col(text))
    return found.select(*[result.alias(c) if c == text else F.col(c) for c in docs.columns])
