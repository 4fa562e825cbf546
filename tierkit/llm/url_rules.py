"""URL filter: a rule list first, then association rules that FP-growth mines from labelled URLs.

A URL's tokens are its scheme, host, host suffix, sites (the last two, three and four labels of its host, so that
hosts of one site count together), sub-domain, path segments,
extension and query keys; numbers become one token, so tokens repeat between
pages. Labelled URLs are baskets of tokens with an item for a bad label, and
Spark's FP-growth finds combinations that reach the support and whose
confidence for the bad label is high, and surely so for the pages seen. Rules are matched through an inverted index:
each rule is listed under its rarest token, distinct token sets (far fewer than
pages, and the same for all pages of a hot host and section) look their tokens
up there, and whole antecedents are compared. Verdicts go back to pages by a
join on the token set.

Defined cases: a null URL or one without ``://`` has an empty host and path, no
tokens and no rule: it is allowed; labels that are null count as good; repeated
rows are judged each; without labelled URLs no rule is mined; an empty table gives
no rows; other columns are ignored but for the id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.common import fresh, saved

BAD = "label:bad"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)(?:\?([^#]*))?"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.005
MIN_CONFIDENCE = 0.6
SURE = (3.0, 0.5)  # of a rule: its confidence, less this many standard errors (Wilson), is at least this
SITE_LABELS = (2, 3, 4)  # last labels of a host that name a site
MOST_SEGMENTS = 4  # path segments with a token of their own place; deeper ones share a place


@dataclass(frozen=True)
class ListRule:
    """Holds for ``host`` and its sub-domains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (ListRule("com", "/", "allow"), ListRule("example.com", "/en/", "block"), ListRule("www.example.com", "/en/", "allow"),
         ListRule("net", "/es/", "block"), ListRule("net", "/fr/", "block"))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def listed(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens; none for a URL without ``://``."""
    url = F.coalesce(url, F.lit(""))
    host, path, query = host_of(url), path_of(url), F.regexp_extract(url, _URL, 3)
    number = lambda c: F.regexp_replace(c, "[0-9]+", "0")
    one = lambda kind, c: F.when(c != "", F.array(F.concat(F.lit(kind + ":"), c))).otherwise(F.array().cast("array<string>"))
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    segments = F.transform(parts, lambda s, i: F.concat(F.lit("path"), F.least(i, F.lit(MOST_SEGMENTS)).cast("string"), F.lit(":"),
                                                       F.regexp_replace(number(s), r"\.[A-Za-z]+$", "")))
    keys = F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), lambda s: F.concat(F.lit("query:"), number(F.substring_index(s, "=", 1))))
    labels = F.split(host, r"\.")
    sites = [one("site", F.when(F.size(labels) >= n, F.substring_index(host, ".", -n)).otherwise("")) for n in SITE_LABELS]
    found = F.concat(
        *sites, one("scheme", F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))), one("host", host),
        one("suffix", F.substring_index(host, ".", -1)), one("sub", F.when(F.size(labels) > 2, F.substring_index(host, ".", 1)).otherwise("")),
        one("ext", F.regexp_extract(path, r"\.([A-Za-z]+)$", 1)), segments, keys)
    return F.array_sort(F.array_distinct(found))


def mine(baskets: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (antecedent, confidence, support) from rows of ``tokens`` and ``bad``."""
    from pyspark.ml.fpm import FPGrowth

    spark = baskets.sparkSession
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens"))
    rows = saved(baskets.where(F.size("tokens") > 0).select(items.alias("items")), "url-baskets")
    if not rows.take(1):
        return spark.createDataFrame([], "antecedent array<string>, confidence double, support double")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(rows)
    z, least = SURE
    p, n = F.col("confidence"), F.col("support") * rows.count() / F.col("confidence")  # pages with the antecedent
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return model.associationRules.where(F.array_contains("consequent", BAD) & (low >= least)).select(
        "antecedent", "confidence", "support")


def match(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """For rows of distinct ``tokens`` that a rule fits: tokens, and the rule of the highest confidence
    (then support, then name) as ``mined_rule``."""
    one = saved(sets.withColumn("set_id", F.monotonically_increasing_id()), "url-sets")
    met = one.select(F.explode("tokens").alias("token"), "set_id")
    counts = met.groupBy("token").count()
    numbered = rules.select(F.array_join(F.array_sort("antecedent"), " ").alias("name"), "*")
    rare = numbered.select("name", F.explode("antecedent").alias("token")).join(counts, "token").groupBy("name").agg(
        F.min(F.struct("count", "token")).alias("least")).select("name", F.col("least.token").alias("token"))
    index = rare.join(numbered, "name")
    hits = met.join(index, "token").join(one, "set_id").where(F.size(F.array_except("antecedent", "tokens")) == 0)
    first = Window.partitionBy("set_id").orderBy(F.col("confidence").desc(), F.col("support").desc(), "name")
    return hits.withColumn("n", F.row_number().over(first)).where("n = 1").select("tokens", F.col("name").alias("mined_rule"))


def judge(pages: DataFrame, labels: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES,
          min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per page: its id, host, path, rule (of the list), mined_rule, verdict (allow or block).

    A page is labelled by the document whose id is the last number of its path; a document of low quality
    or a toxic one is bad.
    """
    url = F.col("url")
    base = pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url")).select(
        "page", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    name, verdict = listed(F.col("host"), F.col("path"), rules)
    base = saved(base.select("*", name.alias("rule"), verdict.alias("list_verdict")), "urls")
    doc = F.regexp_extract("path", r"/([0-9]{1,18})(?:\.[A-Za-z]+)?/?$", 1)
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False)))
    known = labels.select(F.col("doc_id").cast("long").alias("doc"), bad.alias("bad"))
    baskets = base.select("tokens", F.when(doc != "", doc.cast("long")).alias("doc")).where("doc IS NOT NULL").join(known.hint("merge"), "doc")
    mined = saved(mine(baskets.select("tokens", "bad"), min_support, min_confidence), "url-rules")
    # only pages that the list leaves open need the mined rules
    sets = base.where(F.col("rule").isNull() & (F.size("tokens") > 0)).select("tokens").distinct()
    hits = saved(match(sets, mined), "url-hits")
    other = fresh(base, "hit_tokens")
    out = base.join(hits.withColumnRenamed("tokens", other), F.col("tokens") == F.col(other), "left")
    return out.select(
        F.col("page").alias(id_col), "host", "path", "rule", F.when(F.col("rule").isNull(), F.col("mined_rule")).alias("mined_rule"),
        F.coalesce("list_verdict", F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")).alias("verdict"))
