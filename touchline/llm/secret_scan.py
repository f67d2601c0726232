"""Secrets in whole texts: fixed patterns, and sliding-window entropy of candidate strings.

Everything is DataFrame functions. ``split`` and ``regexp_extract_all`` with one
pattern give what lies between the matches and the matches, and running lengths
of both give positions, in code points with an exclusive end.

Patterns find ``assign``, ``access`` and ``hex`` spans. Candidates are longest
runs of base-64 characters that hold a letter and a digit. A window slides over
each; its Shannon entropy ``log2 W - S / W``, S the sum of k * log2 k over the
counts k of its characters, follows from the counts of the character that leaves
and the one that enters. Runs of hexadecimal digits, and stretches of them inside longer runs, have a window
and threshold of their own. From the first to the last window at or above the threshold an
``entropy`` span is added, unless a pattern's span already covers it. Of a run that the
allow-list knows only the harmless part is left out, such as the path before a key.

Defined cases: a NULL text counts as empty and has no spans, with the digest of
the empty string; repeated rows each get theirs; other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.registry import query, table

# The patterns. Runs are longest runs, so a least length may stand in the pattern itself.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}+"
# Hexadecimal stretches inside a longer run, with a letter and a digit as a run has them.
HEX_STRETCH = r"(?<![0-9a-fA-F])(?=[a-fA-F]*[0-9])(?=[0-9]*[a-fA-F])[0-9a-fA-F]{24,}+"
# Runs that are no secrets: UUIDs, digests that name themselves, examples, alphabets, paths.
ALLOWED = (
    r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^(sha(1|224|256|384|512)|md5)-|(?i:example)"
    r"|(?i:abcdefgh|0123456789|qwertyui)|//|^(/?[a-z_-]+/)+"
)
# What of an allowed run is harmless, each over its own extent only; the rest is looked at piece by piece.
ALPHABETS = "|".join(
    head + "".join(f"{c}?" for c in tail)
    for head, tail in [
        ("abcdefgh", "ijklmnopqrstuvwxyz0123456789"),
        ("0123456789", "abcdefghijklmnopqrstuvwxyz"),
        ("qwertyui", "opasdfghjklzxcvbnm"),
    ]
)
HARMLESS = (
    r"^[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$|^(?:sha(?:1|224|256|384|512)|md5)-[A-Za-z0-9+/]{0,128}={0,2}"
    r"|^[A-Za-z0-9+/]{30}EXAMPLEKEY$|(?i:[a-z0-9]*example[a-z0-9]*)"
    rf"|(?i:{ALPHABETS})|^/*(?:[a-z_-]+/+)+|(?<=/)[a-z_-]{{3,}}/"
)
BASE_KINDS = ["assign", "access", "hex"]
KINDS = [*BASE_KINDS, "entropy"]

PARTS = "array<struct<start:int,match:string>>"
SPANS = "array<struct<start:int,rank:int,end:int,kind:string,match:string>>"


@dataclass(frozen=True)
class EntropyClass:
    """A window of so many characters whose entropy in bits has to reach the threshold."""

    pattern: str
    window: int
    threshold: float


CLASSES = [EntropyClass(r"^[0-9a-fA-F]+$", 24, 3.0), EntropyClass(r"", 20, 3.75)]


def _spans(text: Column, pattern: str, matches: Column, kind: str) -> Column:
    """Matches of ``pattern`` with their places, from the texts between them."""
    between = F.split(text, pattern, -1)
    pairs = F.zip_with(matches, F.slice(between, 1, F.size(matches)), lambda m, b: F.struct(m.alias("m"), b.alias("b")))

    def place(state: Column, pair: Column) -> Column:
        start = state["at"] + F.length(pair["b"])
        end = start + F.length(pair["m"])
        span = F.struct(
            start.alias("start"),
            F.lit(KINDS.index(kind)).alias("rank"),
            end.alias("end"),
            F.lit(kind).alias("kind"),
            pair["m"].alias("match"),
        )
        return F.struct(end.alias("at"), F.concat(state["spans"], F.array(span)).alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))
    placed = F.aggregate(pairs, first, place, lambda state: state["spans"])
    return F.when(F.size(matches) > 0, placed).otherwise(F.array().cast(SPANS))


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count)).otherwise(0.0)


def dense_stretch(run: Column, window: int, threshold: float) -> Column:
    """Struct (first, last): where windows of ``run`` at or above the threshold begin first and end last.

    One pass: the counts of the run's different characters are kept in the state,
    and a step changes two of them and, by four terms, the sum S of n * log2(n).
    """
    letters = F.slice(F.split(run, ""), 1, F.length(run))
    # Characters by their places among the different ones of the run, from 0.
    different = F.array_distinct(letters)
    codes = F.transform(letters, lambda c: F.array_position(different, c).cast("int") - 1)
    size = F.lit(window)

    def step(state: Column, i: Column) -> Column:
        # i counts from 0; the window before the step ends at i.
        enters = F.get(codes, i)
        leaves = F.when(i >= size, F.get(codes, i - size)).otherwise(-1)
        same = leaves == enters
        entering = F.get(state["counts"], enters).cast("double")
        leaving = F.get(state["counts"], leaves).cast("double")
        lost = F.when(leaves >= 0, _weight(leaving - 1) - _weight(leaving)).otherwise(0.0)
        won = _weight(entering + 1) - _weight(entering)
        total = state["total"] + F.when(same, 0.0).otherwise(lost + won)
        counts = F.transform(state["counts"], lambda n, j: n + (j == enters).cast("int") - (j == leaves).cast("int"))
        dense = (i >= size - 1) & (F.lit(math.log2(window)) - total / size >= F.lit(threshold - 1e-9))
        return F.struct(
            total.alias("total"),
            counts.alias("counts"),
            F.when(dense & (state["first"] < 0), i - size + 1).otherwise(state["first"]).alias("first"),
            F.when(dense, i + 1).otherwise(state["last"]).alias("last"),
        )

    none = F.struct(
        F.lit(0.0).alias("total"),
        F.transform(different, lambda c: F.lit(0)).alias("counts"),
        F.lit(-1).alias("first"),
        F.lit(-1).alias("last"),
    )
    return F.aggregate(F.sequence(F.lit(0), F.length(run) - 1), none, step)


def _rest(span: Column) -> Column:
    """What the harmless parts leave of a run that the allow-list knows: spans that are candidates themselves."""
    run = span["match"]
    harmless = F.regexp_extract_all(run, F.lit(HARMLESS), F.lit(0))
    between = F.split(run, HARMLESS, -1)
    parts = F.zip_with(between, harmless, lambda b, h: F.struct(b.alias("b"), F.coalesce(h, F.lit("")).alias("h")))

    def place(state: Column, part: Column) -> Column:
        left = F.struct(state["at"].alias("start"), part["b"].alias("match"))
        after = state["at"] + F.length(part["b"]) + F.length(part["h"])
        return F.struct(after.alias("at"), F.concat(state["left"], F.array(left)).alias("left"))

    first = F.struct(span["start"].alias("at"), F.array().cast(PARTS).alias("left"))
    left = F.aggregate(parts, first, place, lambda state: state["left"])
    return F.filter(left, lambda part: part["match"].rlike(CANDIDATE))


def _entropy_spans(candidates: Column, base: Column, classes: list[EntropyClass]) -> Column:
    def stretch(span: Column) -> Column:
        result = None
        for c in classes:
            found = dense_stretch(span["match"], c.window, c.threshold)
            result = F.when(span["match"].rlike(c.pattern), found) if result is None else result.when(
                span["match"].rlike(c.pattern), found
            )
        return result

    def parts(span: Column) -> Column:
        whole = F.array(F.struct(span["start"].alias("start"), span["match"].alias("match")))
        return F.when(span["match"].rlike(ALLOWED), _rest(span)).otherwise(whole)

    def hex_stretches(part: Column) -> Column:
        inside = _spans(part["match"], HEX_STRETCH, F.regexp_extract_all(part["match"], F.lit(HEX_STRETCH), F.lit(0)), "hex")
        inside = F.filter(inside, lambda s: F.length(s["match"]) < F.length(part["match"]))
        return F.transform(
            inside, lambda s: F.struct((part["start"] + s["start"]).alias("start"), s["match"].alias("match"))
        )

    suspects = F.flatten(F.transform(candidates, parts))
    suspects = F.concat(suspects, F.flatten(F.transform(suspects, hex_stretches)))
    spans = F.transform(
        F.transform(suspects, lambda s: F.struct(s["start"].alias("at"), stretch(s).alias("dense"))),
        lambda s: F.struct(
            (s["at"] + s["dense"]["first"]).alias("start"),
            F.lit(KINDS.index("entropy")).alias("rank"),
            (s["at"] + s["dense"]["last"]).alias("end"),
            F.lit("entropy").alias("kind"),
            F.lit("").alias("match"),
        ),
    )
    dense = F.array_distinct(F.filter(spans, lambda s: s["end"] > s["start"]))

    def covers(b: Column, s: Column) -> Column:
        return (b["start"] <= s["start"]) & (b["end"] >= s["end"])

    # Of a run's span and that of a stretch inside it, the one that holds the other stays.
    new = F.filter(
        dense,
        lambda s: ~F.exists(base, lambda b: covers(b, s)) & ~F.exists(dense, lambda o: covers(o, s) & ~covers(s, o)),
    )
    return F.when(F.size(candidates) > 0, new).otherwise(F.array().cast(SPANS))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count_of(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def scan_secrets(docs: DataFrame, text_col: str = "text", classes: list[EntropyClass] = CLASSES) -> DataFrame:
    """``docs`` with ``base_spans`` and ``all_spans``, sorted by start, then kind as listed.

    Both are arrays of (start, rank, end, kind, match).
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "entropy": CANDIDATE}
    found = docs.withColumns(
        {f"_{kind}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for kind, p in patterns.items()}
    )
    placed = found.withColumns({f"_{kind}": _spans(text, p, F.col(f"_{kind}"), kind) for kind, p in patterns.items()})
    long_enough = F.filter(
        "_assign", lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= ASSIGN_LENGTH
    )
    based = placed.withColumn("base_spans", F.array_sort(F.concat(long_enough, F.col("_access"), F.col("_hex"))))
    added = _entropy_spans(F.col("_entropy"), F.col("base_spans"), classes)
    return based.withColumn("all_spans", F.array_sort(F.concat("base_spans", added))).drop(*[f"_{k}" for k in patterns])


@query("op2_secret_scan")
def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = {f"n_{kind}": count_of("base_spans", kind) for kind in BASE_KINDS}
    return scanned.select(
        "doc_id",
        *[c.alias(name) for name, c in count.items()],
        F.sha2(joined(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("all_spans")).alias("spans"),
        count_of("all_spans", "entropy").alias("n_entropy"),
    )
