"""URL filtering by association rules (operator 7), in DataFrame functions and Spark ML only.

Fixed rules on host and path come first: the longest that fits decides.  For the rest FP-growth mines combinations of URL
tokens that go with bad labels; rules that pass the confidence and support limits and clear the base rate, and that no shorter kept
rule implies, block the URLs that hold all their tokens.  Matching uses an inverted index: a rule stands under its rarest
token, URLs look their tokens up there, and only those candidates are compared whole.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from podelta.llm.common import bind, stage

#: Fixed values: (verdict, host, path) of the contract's rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MIN_SUPPORT, MIN_COUNT, MIN_CONFIDENCE = 0.002, 20, 0.6
#: Share of the way from the base rate of bad pages to 1 that a rule's confidence must cover, so that where most pages are bad
#: a rule tells more than that; any base rate can be cleared, and up to 0.4 the confidence limit is the higher one.
MIN_MARGIN = 1 / 3
BAD = "label=bad"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or no ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; null or no ``://``: empty."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(h: Column, p: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; a rule fits its host and all subdomains."""
    table = F.array(*(F.struct(F.lit(len(a + b)).alias("n"), F.lit(a + b).alias("rule"), F.lit(v).alias("verdict"),
                               F.lit(a).alias("host"), F.lit(b).alias("path")) for v, a, b in rules))
    fits = F.filter(table, lambda r: ((h == r["host"]) | F.endswith(h, F.concat(F.lit("."), r["host"]))) & F.startswith(p, r["path"]))
    return bind(F.array_max(fits), lambda r: F.when(r.isNotNull(), F.struct(r["rule"].alias("rule"), r["verdict"].alias("verdict"))))


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: scheme, host labels, path words, query names, fragment; digits become one sign.

    Host labels with digits are tokens as they are, too, so that numbered hosts are told apart.
    """
    whole = F.coalesce(url, F.lit(""))
    scheme = F.when(F.instr(whole, "://") > 0, F.substring_index(whole, "://", 1)).otherwise("")
    query = F.split(F.regexp_extract(whole, r"(?s)\?([^#]*)", 1), "&")
    prefixed = lambda name, parts: F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(
        F.lit(name), F.regexp_replace(F.lower(x), "[0-9]+", "9")))
    return F.array_distinct(F.concat(
        prefixed("scheme=", F.array(scheme)), prefixed("host=", F.split(host(whole), r"\.")),
        F.transform(F.filter(F.split(host(whole), r"\."), lambda x: F.regexp_like(x, F.lit("[0-9]"))), lambda x: F.concat(F.lit("exact="), x)),
        prefixed("path=", F.split(path(whole), "[/.]")), prefixed("query=", F.transform(query, lambda x: F.substring_index(x, "=", 1))),
        prefixed("end=", F.array(F.when(F.instr(whole, "#") > 0, "fragment").otherwise("")))))


def mine(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", label_key: str = "doc_id",
         min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT, min_confidence: float = MIN_CONFIDENCE, min_margin: float = MIN_MARGIN) -> DataFrame:
    """(tokens, confidence, lift, support): token sets that go with a bad label (quality 0 or toxic 1).

    A page's label is the row of ``labels`` with its key; pages without one teach nothing, rows of several labels count
    each.  A rule's support is at least ``min_support`` of the labelled pages and ``min_count`` pages; its confidence is at least
    ``min_confidence`` and covers ``min_margin`` of the way from the share of bad pages to 1.  A rule is pruned if it keeps within the limits but holds another kept rule's tokens.
    """
    bad = ((F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)).alias("bad")
    known = labels.select(F.col(label_key).alias("label_key"), bad)
    baskets = stage(pages.select(F.col(key).alias("page_key"), F.col(url).alias("url"))
                    .join(known, F.col("page_key") == F.col("label_key"))
                    .select(F.concat(tokens(F.col("url")), F.when(F.col("bad"), F.array(F.lit(BAD))).otherwise(F.array().cast("array<string>"))).alias("items")),
                    "baskets")
    schema = "tokens array<string>, confidence double, lift double, support double"
    n, base = baskets.agg(F.count("*"), F.coalesce(F.avg(F.array_contains("items", BAD).cast("double")), F.lit(0.0))).first()
    if n < min_count:
        return pages.sparkSession.createDataFrame([], schema)
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_count / n)), minConfidence=min_confidence).fit(baskets)
    rules = stage(model.associationRules.where((F.size("consequent") == 1) & (F.col("consequent")[0] == BAD) & (F.col("confidence") >= base + min_margin * (1 - base) - 1e-9))
                  .select(F.array_sort("antecedent").alias("tokens"), "confidence", "lift", "support"), "rules")
    # A longer rule that contains a kept one can match nothing more: join each rule to the rules under each of its tokens.
    posted = rules.select(F.col("tokens").alias("short"), F.col("tokens")[0].alias("token"))
    implied = (rules.select("tokens", F.explode("tokens").alias("token")).join(posted, "token")
               .where((F.size("short") < F.size("tokens")) & (F.size(F.array_except("short", "tokens")) == 0)).select("tokens"))
    return rules.join(implied, "tokens", "left_anti")


def match(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The distinct URLs that hold all tokens of some rule.

    Rules are indexed under their rarest token (by how many rules hold it), so few rules share a posting.
    """
    each = rules.select("tokens", F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(F.count("*").alias("n"))
    index = stage(each.join(held, "token").groupBy("tokens").agg(F.min_by("token", F.struct("n", "token")).alias("token")), "index")
    have = urls.select(F.col(url).alias("url")).distinct().select("url", tokens(F.col("url")).alias("have"))
    looked_up = have.select("url", "have", F.explode("have").alias("token")).join(index, "token")
    return looked_up.where(F.size(F.array_except("tokens", "have")) == 0).select("url").distinct()


def judge(pages: DataFrame, labels: DataFrame, key: str = "page_id", url: str = "url", label_key: str = "doc_id",
          rules=RULES, **limits) -> DataFrame:
    """(key, host, path, rule, verdict) for every row of ``pages``.

    A fixed rule decides where one fits.  Else the URL is blocked if a mined rule matches it, and allowed otherwise.  A URL
    without ``://`` has an empty host and path and is judged by its other tokens; a null URL has no token and is allowed.
    Null keys stay, repeated rows are judged one by one, an empty table gives no rows; other columns are neither read nor
    returned.
    """
    mined = mine(pages, labels, key, url, label_key, **limits)
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"))
    rows = rows.select("key", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    hits = stage(match(rows.where("fit IS NULL"), mined), "hits").select(F.col("url").alias("hit"))
    return (rows.join(hits, F.col("url") == F.col("hit"), "left")
            .select(F.col("key").alias(key), "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", F.when(F.col("hit").isNotNull(), "block").otherwise("allow")).alias("verdict")))
