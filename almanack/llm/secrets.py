"""Secret scans with Spark expressions alone.

Base kinds are leftmost non-overlapping matches of their patterns, checked afterwards:
``assign``, ``access``, ``hex``. The method adds ``entropy``: candidate strings (runs of
characters that keys are made of) are scanned with a sliding window whose Shannon entropy is
kept by incremental counts: a step changes the counts of the entering and the leaving
character only. The highest entropy of any window decides, by character class. Candidates that
are on the allow-list are left out. They are looked for in what is left of the text once the base
spans are blanked, one kind after the other, so that a key beside a base span is seen.

Spans are in code points, end exclusive. A text is cut at the matches (``split``), and the
lengths of the pieces and matches give the places. Null and empty texts have no spans.
Rows are independent: repeated rows, ties and null ids need no care, an empty table gives an empty one. No shuffle.
Only doc_id and text are read, so that other columns may have any name. A text's work grows with
its length and the number of its spans, by a small part of their square (n spans: n² / 16,384 numbers copied).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Patterns of the base kinds. A run below its least length is dropped, as no later start
#: within the same run could be longer.
ASSIGN = (
    r"(?i)(password|passwd|secret|token|api_?key)"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
BASE_KINDS = ("assign", "access", "hex")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE = 6

WINDOW = 20
#: Least entropy in bits of the richest window, by character class. A window of 20 has at most
#: log2(20) = 4.32 bits; words of one letter case stay below 3.5.
#: Candidates without a digit must be letters alone, of both cases, and have more entropy: names of
#: several words stay below that.
ENTROPY_LIMITS = {"hex": 3.0, "one_case": 3.6, "mixed": 3.8, "letters": 4.1}
#: Matches whose places are summed in one go.
BLOCK = 128
#: Allow-list: identifiers and well-known examples, by pattern over the whole candidate.
ALLOWED = (
    r"(?i)^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"  # UUIDs
    r"|^[0-9_=+/-]+$"  # no letter
    r"|(?-i:^[a-z]+$|^[A-Z]+$)|^[^0-9]*[_=+/-][^0-9]*$"  # neither digits nor two cases; paths
    r"|(?i)example|placeholder|changeme|your[-_]?(api|key|token|secret)"
    r"|(?i)0123456789|abcdefgh"
    r"|^sha(1|256|384|512)-"  # digests that pages name for their resources
)

#: Characters of candidates have codes 43 to 122.
_LOW, _SPREAD = 43, 80


def _cut(text: Column, pattern: str) -> Column:
    """Array of (piece, value): what lies before each match, and the match; last, the rest and null."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("piece"), m.alias("value")))


def _with(value: Column, use) -> Column:
    """``use(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _spans(text: Column, pattern: str, kind: str) -> Column:
    """Array of (kind, begin, end, value) of all matches.

    Places are running sums of lengths. An array that grows is copied at each step, so sums
    are taken in blocks of ``BLOCK`` matches, from sums over whole blocks.
    """

    def length(pair: Column) -> Column:
        return F.length(pair["piece"]) + F.coalesce(F.length(pair["value"]), F.lit(0))

    def placed(block: Column, start: Column) -> Column:
        def step(state: Column, pair: Column) -> Column:
            begin = state["at"] + F.length(pair["piece"])
            end = begin + F.length(pair["value"])
            span = F.struct(
                F.lit(kind).alias("kind"), begin.alias("begin"), end.alias("end"), pair["value"].alias("value")
            )
            found = F.when(pair["value"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], F.array(span)))
            return F.struct(F.coalesce(end, begin).alias("at"), found.alias("spans"))

        first = F.struct(start.alias("at"), F.from_json(F.lit("[]"), _SPANS).alias("spans"))
        return F.aggregate(block, first, step, lambda s: s["spans"])

    def in_blocks(pairs: Column) -> Column:
        count = F.ceil(F.size(pairs) / BLOCK).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), count - 1), lambda b: F.slice(pairs, b * BLOCK + 1, BLOCK))
        return _with(blocks, lambda bs: F.flatten(F.zip_with(bs, starts(bs), placed)))

    def starts(blocks: Column) -> Column:
        sizes = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, pair: n + length(pair)))
        none = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        return F.aggregate(
            sizes,
            none,
            lambda s, n: F.struct((s["at"] + n).alias("at"), F.concat(s["all"], F.array(s["at"])).alias("all")),
            lambda s: s["all"],
        )

    return _with(_cut(text, pattern), in_blocks)


def _is_span(kind: str, value: Column) -> Column:
    """Whether a match of a base kind passes."""
    if kind == "assign":
        return F.length(F.regexp_extract(value, ASSIGN, 2)) >= LEAST_VALUE
    return F.lit(True)


def _passing(text: Column, pattern: str, kind: str) -> Column:
    return F.filter(_spans(text, pattern, kind), lambda span: _is_span(kind, span["value"]))


def _blanked(text: Column, pattern: str, kind: str) -> Column:
    """The text with the spans of a kind written over, each character by a blank."""

    def shown(pair: Column) -> Column:
        value = pair["value"]
        blank = F.when(_is_span(kind, value), F.repeat(F.lit(" "), F.length(value))).otherwise(value)
        return F.concat(pair["piece"], F.coalesce(blank, F.lit("")))

    return _with(text, lambda t: F.array_join(F.transform(_cut(t, pattern), shown), ""))


_SPANS = "array<struct<kind:string,begin:int,end:int,value:string>>"


def _weight(count: Column) -> Column:
    """count * log2(count), the part of one character in the entropy's sum."""
    return F.when(count > 1, count * F.log2(count)).otherwise(F.lit(0.0))


def window_entropy(value: Column, window: int = WINDOW) -> Column:
    """The highest Shannon entropy in bits of any window of an ASCII string."""
    codes = F.transform(F.split(value, ""), lambda c: F.ascii(c) - _LOW)

    def step(state: Column, i: Column) -> Column:
        enters = F.element_at(state["codes"], i)
        leaves = F.when(i > window, F.element_at(state["codes"], i - window)).otherwise(F.lit(-1))
        into = F.element_at(state["counts"], enters + 1)
        outof = F.when(leaves >= 0, F.element_at(state["counts"], leaves + 1)).otherwise(F.lit(0))
        same = enters == leaves
        total = F.when(same, state["total"]).otherwise(
            state["total"]
            + _weight(into + 1)
            - _weight(into)
            + F.when(leaves >= 0, _weight(outof - 1) - _weight(outof)).otherwise(F.lit(0.0))
        )
        counts = F.when(same, state["counts"]).otherwise(
            F.transform(
                state["counts"],
                lambda n, j: n + (j == enters).cast("int") - (j == leaves).cast("int"),
            )
        )
        size = F.least(i, F.lit(window))
        entropy = F.when(i >= window, F.log2(size) - total / size).otherwise(F.lit(0.0))
        return F.struct(
            state["codes"].alias("codes"),
            counts.alias("counts"),
            total.alias("total"),
            F.greatest(state["best"], entropy).alias("best"),
        )

    start = F.struct(
        codes.alias("codes"),
        F.array_repeat(F.lit(0), _SPREAD).alias("counts"),
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("best"),
    )
    return F.aggregate(F.sequence(F.lit(1), F.length(value)), start, step, lambda s: s["best"])


def _is_rich(value: Column) -> Column:
    limit = (
        F.when(value.rlike("^([0-9a-f]+|[0-9A-F]+)$"), F.lit(ENTROPY_LIMITS["hex"]))
        .when(value.rlike("^([^A-Z]+|[^a-z]+)$"), F.lit(ENTROPY_LIMITS["one_case"]))
        .when(value.rlike("^[^0-9]+$"), F.lit(ENTROPY_LIMITS["letters"]))
        .otherwise(F.lit(ENTROPY_LIMITS["mixed"]))
    )
    return ~value.rlike(ALLOWED) & (window_entropy(value) >= limit)


def find_secrets(docs: DataFrame) -> DataFrame:
    """A row for each document: counts by base kind, digest of the base spans, all spans."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lower = F.lower(text)
    none = F.from_json(F.lit("[]"), _SPANS)
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    named = F.lit(False)
    for word in ASSIGN_WORDS:
        named = named | F.contains(lower, F.lit(word))

    def only(condition: Column, spans: Column) -> Column:
        """Most texts hold no match: these are scanned once."""
        return F.when(condition, spans).otherwise(none)

    present = {"assign": named, "access": F.contains(text, F.lit("AKIA")), "hex": text.rlike(HEX)}
    found = docs.select("doc_id", text.alias("text"), *(c.alias(f"has_{k}") for k, c in present.items()))
    spans, rest = {}, F.col("text")
    for kind, pattern in patterns.items():
        here = F.col(f"has_{kind}")
        spans[kind] = only(here, _passing(F.col("text"), pattern, kind)).alias(kind)
        rest = F.when(here, _blanked(rest, pattern, kind)).otherwise(rest)
    found = found.select("doc_id", *spans.values(), rest.alias("rest"))
    candidates = only(F.col("rest").rlike(CANDIDATE), _spans(F.col("rest"), CANDIDATE, "entropy"))
    more = F.filter(candidates, lambda s: _is_rich(s["value"]))
    base = F.concat("assign", "access", "hex")
    return found.select(
        "doc_id",
        *(F.size(kind).cast("long").alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.concat(base, more)).alias("spans"),
    )


def _joined(spans: Column) -> Column:
    """kind:begin:end by begin, then kind in the order assign, access, hex, entropy."""
    rank = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}

    def order(span: Column) -> Column:
        number = F.create_map(*(F.lit(x) for pair in rank.items() for x in pair))[span["kind"]]
        return F.struct(
            span["begin"].alias("begin"), number.alias("rank"), span["end"].alias("end"), span["kind"].alias("kind")
        )

    parts = F.array_sort(F.transform(spans, order))
    return F.array_join(
        F.transform(parts, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ","
    )
