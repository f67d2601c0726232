"""The trie of all prefixes of sequences, with totals over subtrees, by van Emde Boas recursion on depth.

A range of depths is cut at its half. Sequences that reach beyond the cut are
named there by the prefix they share; the upper trie and the lower forests, one
per named prefix, are problems of half the depth. All ranges of one level of the
recursion are worked at the same time, as rows of one table, so a round of joins
serves a level and their number grows with the logarithm of the depth. The
recursion ends with ranges of 16 turns, which are one row each and need no join.

Names are hashes of 128 bits. Going up, the halves of every range are put
together into the name of its turns; going down, the name of a cut prefix follows
from the name of its range's beginning and the name of the upper half. Nodes are
prefixes with equal names. Subtree totals begin inside the ranges of 16 turns;
then, level by level, the totals of the lower forest under a cut prefix are
grafted on that prefix and its ancestors in the upper trie. Only one member of a
node carries a graft upward, so copies cost nothing there.

No step gathers a node's members: counts are summed before they are shuffled,
a node's many children find their parent by a broadcast of frequent parents, and
the ids hashed for a node are sorted over many tasks and joined to pieces of text
there; a single task only hashes the pieces of a node one after another, as
SHA-256 asks for. A very long sequence is a row per 16 turns.

Defined cases: sequences without turns belong to the root alone; rows without an
id belong to no sequence; NULL roles and texts are empty; equal turn numbers are
ordered by role and MD5 of the text, so repeated rows are turns in a row; an
empty table has no nodes, not even a root; only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.hot_keys import join_counted
from touchline.llm.registry import query, table
from touchline.operators.skew import row_numbers
from touchline.session import written

# Turns of a range that is not cut further.
SPAN = 16
ROOT = hashlib.md5(b"").digest()

# Parameters of the rebuilt conversations: neighbours in groups share first turns.
GROUP = 5
SHARED = 9

PIECES = "name binary, first long, piece string"
HASHED = "name binary, ends_sha256 string"


def _named(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, symbol, bytes): turns numbered from 1; a symbol names role and text."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.unhex(F.md5(text.cast("binary"))).alias("text_name"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_name")]
    placed = row_numbers(rows, ["conv_id"], {"pos": order}, any_size=True)
    symbol = _named(F.unhex(F.md5(F.col("role").cast("binary"))), F.col("text_name"))
    return written(placed.select("conv_id", "pos", symbol.alias("symbol"), "bytes"), "turns")


def rebuilt(conversations: DataFrame, group: int = GROUP, shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """Sequences (conv_id, pos, symbol, bytes) and their ids: first turns are those of the first of a group.

    A conversation c takes the first h turns of c - c % group, h = crc32(c) % shared,
    and keeps its own turns after its first h.
    """
    turns = numbered_turns(conversations)
    own_lengths = turns.groupBy("conv_id").agg(F.max("pos").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % F.lit(shared)).alias("h")
    lengths = written(own_lengths.select("conv_id", "n", h, (F.col("conv_id") - F.col("conv_id") % group).alias("base")), "lengths")
    bases = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0))).alias("taken")
    plans = written(lengths.join(bases, "base", "left").select("conv_id", "n", "h", "base", taken), "plans")
    own = join_counted(turns, plans.select("conv_id", "n", "h", "taken"), ["conv_id"], "n").where("pos > h")
    own = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "symbol", "bytes")
    first = turns.where(F.col("pos") < shared).withColumnRenamed("conv_id", "base")
    borrowed = first.join(plans.where("taken > 0").select("conv_id", "base", "taken"), "base").where("pos <= taken")
    rows = own.unionByName(borrowed.select("conv_id", "pos", "symbol", "bytes"))
    return written(rows, "sequences"), plans.select("conv_id")


def _names_inside(turns: Column) -> Column:
    """Names of the prefixes of a range's turns, shortest first."""
    start = F.array().cast("array<binary>")
    before = lambda names: F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit(b""))
    return F.aggregate(turns, start, lambda names, t: F.concat(names, F.array(_named(before(names), t["symbol"]))))


def _cut_names(ranges: DataFrame, levels: int) -> DataFrame:
    """(conv_id, span, before): the name of the prefix before a range, and of the one after the last if that has all its turns.

    ``ranges`` (conv_id, span, name) are those with all their turns.
    """
    halves = [ranges]
    for _ in range(levels - 1):
        pairs = halves[-1].groupBy("conv_id", F.shiftright("span", 1).alias("span")).agg(
            F.max(F.when(F.col("span") % 2 == 0, F.col("name"))).alias("upper"),
            F.max(F.when(F.col("span") % 2 == 1, F.col("name"))).alias("lower"),
        )
        pairs = pairs.where("upper is not null and lower is not null")
        halves.append(written(pairs.select("conv_id", "span", _named("upper", "lower").alias("name")), "halves"))
    known = ranges.where("span = 0").select("conv_id", "span", F.lit(ROOT).alias("before"))
    for level in range(levels - 1, -1, -1):
        upper = halves[level].where(F.col("span") % 2 == 0)
        upper = upper.select("conv_id", (F.col("span") * (1 << level)).alias("span"), "name")
        cut = known.join(upper, ["conv_id", "span"])
        cut = cut.select("conv_id", (F.col("span") + (1 << level)).alias("span"), _named("before", "name").alias("before"))
        known = written(known.unionByName(cut), "cut-names")
    return known.where("span > 0")


def _paths(sequences: DataFrame) -> tuple[DataFrame, int]:
    """(conv_id, span, before, names, bytes) per range of 16 turns, and the number of levels above these ranges."""
    turn = F.struct("pos", "symbol", "bytes")
    span = F.floor((F.col("pos") - 1) / F.lit(SPAN)).alias("span")
    ranges = sequences.groupBy("conv_id", span).agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    ranges = ranges.select("conv_id", "span", _names_inside(F.col("turns")).alias("inside"), F.col("turns.bytes").alias("bytes"))
    ranges = written(ranges, "ranges")
    last = ranges.agg(F.max("span")).first()[0] or 0
    levels = int(last).bit_length()
    ranges = ranges.withColumns({"before": F.lit(None).cast("binary"), "after": F.lit(None).cast("binary")})
    if levels:
        full = ranges.where(F.size("inside") == SPAN).select("conv_id", "span", F.element_at("inside", -1).alias("name"))
        cuts = _cut_names(full, int(last + 1).bit_length())
        ends = cuts.select("conv_id", (F.col("span") - 1).alias("span"), F.col("before").alias("after"))
        ranges = ranges.drop("before", "after").join(cuts, ["conv_id", "span"], "left").join(ends, ["conv_id", "span"], "left")
    before = F.coalesce("before", F.lit(ROOT))
    names = F.transform("inside", lambda name: _named(before, name))
    # The end of a full range is a cut, with the name that the recursion gave it.
    whole = F.concat(F.slice(names, 1, SPAN - 1), F.array("after"))
    names = F.when(F.col("after").isNull(), names).otherwise(whole)
    return written(ranges.select("conv_id", "span", before.alias("before"), names.alias("names"), "bytes"), "paths"), levels


def _grafted(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(name, n_leaves, saved_tokens) summed over the subtree of every node."""
    sums = [F.sum(c).alias(c) for c in ("n_leaves", "saved_tokens")]
    own = F.struct("at", "n_leaves", "saved_tokens")
    owned = nodes.groupBy("conv_id", "span").agg(F.collect_list(own).alias("own"), F.max("at").alias("deepest"))

    def below(at: Column, field: str) -> Column:
        inside = F.filter("own", lambda x: x["at"] >= at)
        return F.aggregate(inside, F.lit(0).cast("long"), lambda total, x: total + x[field])

    inner = F.transform(
        F.sequence(F.lit(0), F.col("deepest")),
        lambda at: F.struct(
            F.element_at("names", at + 1).alias("name"),
            below(at, "n_leaves").alias("n_leaves"),
            below(at, "saved_tokens").alias("saved_tokens"),
        ),
    )
    totals = owned.join(paths.select("conv_id", "span", "names"), ["conv_id", "span"]).select(F.inline(inner))
    totals = written(totals.groupBy("name").agg(*sums), "totals")
    heads = nodes.where("at = 0 and span > 0").select("name", "parent", "span") if levels else None
    for level in range(levels):
        width = 1 << level
        # Lower halves begin at odd multiples of their width.
        lower = heads.where(F.col("span") % (2 * width) == width).join(totals, "name")
        cut = lower.groupBy("parent").agg(F.min("span").alias("span"), *sums)
        cut = cut.join(nodes.select(F.col("name").alias("parent"), "conv_id"), "parent")
        reach = cut.withColumn("span", F.explode(F.sequence(F.col("span") - width, F.col("span") - 1)))
        grafts = reach.join(paths.select("conv_id", "span", "names"), ["conv_id", "span"])
        grafts = grafts.select(F.explode("names").alias("name"), "n_leaves", "saved_tokens")
        totals = written(totals.unionByName(grafts).groupBy("name").agg(*sums), "totals")
    return totals


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (name, id) in order, as the comma-joined ids of a name; a batch of rows bounds a piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        code = batch.column(0).dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        lists = pa.ListArray.from_arrays(
            pa.array(np.r_[cuts, batch.num_rows].astype(np.int32)), pc.cast(batch.column(1), pa.string())
        )
        at = pa.array(cuts)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pc.binary_join(lists, ",")], names=["name", "first", "piece"]
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The SHA-256 of each name's pieces, which come in order."""
    name, state = None, None
    for batch in batches:
        names, found = [], []
        for key, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if key != name:
                if state is not None:
                    names.append(name)
                    found.append(state.hexdigest())
                name, state = key, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(found, pa.string())], names=["name", "ends_sha256"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([state.hexdigest()])], names=["name", "ends_sha256"])


def hashed_ids(rows: DataFrame) -> DataFrame:
    """(name, ends_sha256) of rows (name, conv_id): the hash of a name's ids, ascending, joined by commas."""
    placed = rows.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id")
    parts = written(placed.mapInArrow(_pieces, PIECES), "pieces")
    return parts.repartition("name").sortWithinPartitions("name", "first").mapInArrow(_hashed, HASHED)


def prefix_trie(sequences: DataFrame, ids: DataFrame) -> DataFrame:
    """A row per distinct prefix of ``sequences`` (conv_id, pos, symbol, bytes), positions from 1 without gaps.

    ``ids`` (conv_id) has every sequence once, those without turns included.
    Columns: conv_id (the smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    paths, levels = _paths(sequences)
    members = paths.select("conv_id", "span", "before", "names", F.posexplode(F.arrays_zip("names", "bytes")).alias("at", "turn"))
    parent = F.when(F.col("at") == 0, F.col("before")).otherwise(F.try_element_at("names", F.col("at")))
    nodes = members.groupBy(F.col("turn.names").alias("name")).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("span").alias("span"),
        F.min("at").alias("at"),
        F.min(parent).alias("parent"),
        F.min("turn.bytes").alias("bytes"),
        F.count(F.lit(1)).alias("n_convs"),
    )
    nodes = written(nodes, "nodes")
    children = nodes.groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "name", "left").withColumns(
        {
            "n_children": F.coalesce("n_children", F.lit(0)).cast("long"),
            "n_leaves": F.col("n_children").isNull().cast("long"),
            "saved_tokens": (F.col("n_convs") - 1) * F.col("bytes"),
        }
    )
    nodes = written(nodes, "counted-nodes")
    totals = _grafted(nodes, paths, levels)
    top = nodes.where("at = 0 and span = 0")
    below = top.join(totals.select("name", F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")), "name")
    n_children, n_leaves, saved = below.agg(F.count(F.lit(1)), F.sum("leaves"), F.sum("saved")).first()
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0")
    root = root.select(
        F.lit(ROOT).alias("name"),
        "conv_id",
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        "n_convs",
        F.lit(n_children).cast("long").alias("n_children"),
        F.lit(n_leaves or 1).cast("long").alias("n_leaves"),
        F.lit(saved or 0).cast("long").alias("saved_tokens"),
    )
    root = written(root, "root")
    parents = nodes.where("n_children > 0").select(
        F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"
    )
    parents = parents.unionByName(root.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "n_children"))
    inner = join_counted(
        nodes.drop("n_leaves", "saved_tokens", "bytes").withColumnRenamed("n_children", "own_children"),
        written(parents, "parents"),
        ["parent"],
        "n_children",
    )
    inner = inner.join(totals, "name").select(
        "name",
        "conv_id",
        (F.col("span") * SPAN + F.col("at") + 1).cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        F.col("own_children").alias("n_children"),
        "n_leaves",
        "saved_tokens",
    )
    lasts = paths.groupBy("conv_id").agg(F.max_by(F.element_at("names", -1), "span").alias("name"))
    ends = ids.join(lasts, "conv_id", "left").select(F.coalesce("name", F.lit(ROOT)).alias("name"), "conv_id")
    hashes = hashed_ids(written(ends, "ends"))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return (
        root.unionByName(inner)
        .join(hashes, "name", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nothing))
        .drop("name")
    )


SQL = f"""
WITH RECURSIVE own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), lengths AS (SELECT c, max(pos) AS n FROM own GROUP BY c),
crc AS (
  SELECT c, c::VARCHAR AS s, 0 AS i, 4294967295::BIGINT AS v FROM lengths
  UNION ALL
  SELECT c, s, i + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384::BIGINT) ELSE w >> 1 END
  FROM (SELECT c, s, i, CASE WHEN i % 8 = 0 THEN xor(v, ascii(s[i // 8 + 1])::BIGINT) ELSE v END AS w FROM crc WHERE i < 8 * len(s))
), plans AS (
  SELECT l.c, h, least(h, coalesce(b.n, 0)) AS taken, l.c - l.c % {GROUP} AS base
  FROM (SELECT c, xor(v, 4294967295::BIGINT) % {SHARED} AS h FROM crc WHERE i = 8 * len(s)) AS l LEFT JOIN lengths b ON b.c = l.c - l.c % {GROUP}
), turns AS (
  SELECT c, pos - h + taken AS d, role, text FROM own JOIN plans USING (c) WHERE pos > h
  UNION ALL SELECT p.c, pos, role, text FROM plans p JOIN own ON own.c = p.base AND pos <= taken
), lists AS (SELECT c, list(md5(role) || md5(text) ORDER BY d) AS t, list(strlen(text) ORDER BY d) AS b FROM turns GROUP BY c),
paths AS MATERIALIZED (
  SELECT c, d, md5(array_to_string(t[:d], '')) AS name, CASE WHEN d = 1 THEN '' ELSE md5(array_to_string(t[:d - 1], '')) END AS parent,
    b[d] AS bytes, d = len(t) AS ends
  FROM (SELECT *, unnest(range(1, len(t) + 1)) AS d FROM lists)
  UNION ALL SELECT c, 0, '', NULL, 0, c NOT IN (SELECT c FROM lists) FROM lengths
), nodes AS MATERIALIZED (
  SELECT name, min(c) AS conv_id, min(d) AS depth, min(parent) AS parent, count(*) AS n_convs, (count(*) - 1) * min(bytes) AS saved,
    sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM paths GROUP BY name
), children AS (SELECT parent AS name, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
totals AS (
  SELECT p.name, count(*) FILTER (u.name NOT IN (SELECT name FROM children)) AS n_leaves, sum(u.saved)::BIGINT AS saved
  FROM nodes u JOIN paths p ON p.c = u.conv_id AND p.d <= u.depth GROUP BY p.name
)
SELECT v.conv_id, v.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(children.n, 0) AS n_children,
  n_leaves, totals.saved AS saved_tokens, v.ends_sha256
FROM nodes v JOIN totals USING (name) LEFT JOIN children USING (name) LEFT JOIN nodes p ON p.name = v.parent
"""


@query("op13_prefix_trie", SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(table(spark, sf_dir, "conversations")))
