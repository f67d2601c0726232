"""URL filter: a blocked Bloom filter of listed URLs, then an exact join for its hits.

A list entry is a host and a path prefix with a verdict. It fits its host and
all subdomains if the path of a URL starts with its path; of several fitting
entries the longest decides, of equally long ones the blocking one. A URL that
fits no entry gets the default verdict.

Every URL yields one canonical key for each of its host suffixes and each path
length that the list holds. The filter drops almost all keys that are not
listed, by a join with its blocks; the exact join with the list removes the
false positives.

Defined cases: a NULL URL or one without ``://`` has an empty host and path and
gets the default verdict; repeated rows each get theirs; an empty list or an
empty table is fine; other columns of the pages are neither read nor returned.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm.hot_keys import join_counted
from touchline.llm.registry import query, table
from touchline.operators.skew import bounded_broadcast
from touchline.session import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BITS_PER_KEY = 16
BLOCK_BITS = 256
# The odd multipliers of split block Bloom filters, one for each 32-bit word of a block.
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]

# The production list.
RULES = [
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
]


def url_host(url: str | Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, UPPER.lower()), F.lit(""))


def url_path(url: str | Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: str | Column) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def _masks(key: Column) -> list[Column]:
    """One bit of each of the eight words of a block, from the low 31 bits of the key's hash."""
    low = F.xxhash64(key).bitwiseAND(F.lit(0x7FFFFFFF))
    return [F.call_function("shiftleft", F.lit(1).cast("long"), _bit(low, salt)) for salt in SALTS]


def _bit(low: Column, salt: int) -> Column:
    return F.shiftright((low * F.lit(salt)).bitwiseAND(F.lit(0xFFFFFFFF)), 27).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(key), 32), F.lit(blocks))


def bloom_blocks(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table: a row for every block that holds a key, its words as w0 to w7."""
    words = [F.bit_or(mask).alias(f"w{i}") for i, mask in enumerate(_masks(F.col(key)))]
    return keys.groupBy(_block(F.col(key), blocks).alias("block")).agg(*words)


def possible_hits(candidates: DataFrame, key: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """Candidates whose bits are all set; no listed key is lost.

    The blocks are broadcast only after they were counted and found few.
    """
    tested = candidates.withColumn("block", _block(F.col(key), blocks)).join(bounded_broadcast(bloom), "block")
    found = [F.col(f"w{i}").bitwiseAND(mask) == mask for i, mask in enumerate(_masks(F.col(key)))]
    return tested.where(reduce(lambda a, b: a & b, found)).select(*candidates.columns)


def filter_urls(
    pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """id, host, path, rule and verdict of every page; ``rules`` has (rule, verdict).

    The lengths of listed paths are read back; there are at most as many as the
    longest listed path has characters.
    """
    pages = pages.select(
        F.col(id_col).alias("page_id"), url_host(url_col).alias("host"), url_path(url_col).alias("path")
    )
    rules = rules.select("rule", "verdict").where("rule is not null").groupBy("rule").agg(F.max("verdict").alias("verdict"))
    rule_path = F.regexp_extract("rule", r"^[^/]*(.*)$", 1)
    lengths = sorted(r[0] for r in rules.select(F.length(rule_path)).distinct().collect())
    blocks = max(1, -(-rules.count() * BITS_PER_KEY // BLOCK_BITS))
    bloom = bloom_blocks(rules, "rule", blocks)

    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths] or [F.lit(-1)]), lambda n: (n >= 0) & (n <= F.length("path")))
    urls = written(pages.where("host <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages")), "urls")
    keys = (
        urls.withColumn("suffix", F.explode(suffixes))
        .withColumn("length", F.explode(fitting))
        .select("host", "path", F.concat("suffix", F.expr("substring(path, 1, length)")).alias("rule"))
    )
    decided = (
        possible_hits(keys, "rule", bloom, blocks)
        .join(rules, "rule")
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("length"), "rule", "verdict")).alias("best"))
        .select("host", "path", "best.rule", "best.verdict")
    )
    # Every URL once, with its number of pages: very common ones are joined by broadcast, pages without a host by nothing.
    verdicts = written(urls.join(decided, ["host", "path"], "left"), "verdicts")
    found = join_counted(pages.where("host <> ''"), verdicts, ["host", "path"], "pages")
    found = found.unionByName(pages.where("host = ''"), allowMissingColumns=True)
    return found.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"))


def rule_table(spark: SparkSession, rules: list[tuple[str, str]] = RULES) -> DataFrame:
    return spark.createDataFrame(rules, "rule string, verdict string")


def _rule_sql() -> str:
    values = ", ".join(f"('{rule}', '{verdict}')" for rule, verdict in RULES)
    return f"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages
), split AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{UPPER.lower()}'), '') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
  FROM parts
), rules AS (
  SELECT rule, verdict, substr(rule, 1, strpos(rule, '/') - 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path
  FROM (VALUES {values}) AS v(rule, verdict)
), best AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM split)
  JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY host, path
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM split LEFT JOIN best USING (host, path)
"""


@query("op8_url_filter", _rule_sql())
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages"), rule_table(spark))
