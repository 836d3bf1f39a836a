"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

Everything is column expressions and Spark ML: no Python runs in tasks.  The trees learn from URLs whose label is known (here:
those that a rule decides) and see only how a URL is written: lengths, depth, digits, entropy, parameters, punctuation, and how
often labelled URLs with the same host suffix were blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigia.llm.common import stored

#: Labelled URLs of each label that the trees are fitted on, at most; chosen by hash.
FIT_PER_LABEL = 10_000
TREES, DEPTH = 12, 4
#: Pseudo-count of the suffix statistics.
PRIOR = 20.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host, its subdomains and the paths that start with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case; '' without."""
    rest = F.substring_index(_rest(url), "/", 1)
    return F.translate(F.substring_index(F.substring_index(rest, "?", 1), "#", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    rest = F.substring_index(F.substring_index(_rest(url), "?", 1), "#", 1)
    cut = F.instr(rest, "/")
    return F.when(cut > 0, F.substring(rest, cut, F.length(rest))).otherwise("")


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule_hit(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(name, verdict) of the longest rule that fits, NULL if none does; of equal lengths the first."""
    found = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def _count(text: Column, characters: str) -> Column:
    """How many of ``text``'s characters are among ``characters``."""
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits for each character of a short text (the host)."""
    size = F.length(text)
    letters = F.array_distinct(F.filter(F.split(text, ""), lambda c: c != ""))
    share = F.transform(letters, lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    return F.when(size > 0, F.aggregate(share, F.lit(0.0), lambda total, p: total - p * F.log2(p))).otherwise(0.0)


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features of a URL that is not NULL; its suffix statistics come by join."""
    query = F.when(F.instr(url, "?") > 0, F.substring_index(F.substring_index(url, "?", -1), "#", 1)).otherwise("")
    length = F.length(url).cast("double")
    first = F.get(F.split(path, "/"), F.lit(1))
    return {
        "url_length": F.log1p(length),
        "host_length": F.length(host).cast("double"),
        "path_length": F.log1p(F.length(path).cast("double")),
        "depth": _count(path, "/"),
        "labels": _count(host, "."),
        "digit_ratio": F.when(length > 0, _count(url, "0123456789") / length).otherwise(0.0),
        "host_digits": _count(host, "0123456789"),
        "hyphens": _count(host, "-"),
        "parameters": F.when(query != "", _count(query, "&") + 1.0).otherwise(0.0),
        "query_length": F.log1p(F.length(query).cast("double")),
        "escapes": _count(url, "%@~"),
        "fragment": (F.instr(url, "#") > 0).cast("double"),
        "secure": F.startswith(F.lower(url), F.lit("https")).cast("double"),
        "first_length": F.coalesce(F.length(first), F.lit(0)).cast("double"),
        "host_entropy": _entropy(host),
        "path_entropy": F.when(F.length(path) > 0, _count(path, "aeiou") / F.length(path)).otherwise(0.0),
    }


def _suffixes(host: Column) -> dict[str, Column]:
    """The last one and the last two labels of a host."""
    return {"tld": F.substring_index(host, ".", -1), "domain": F.substring_index(host, ".", -2)}


def judge(df: DataFrame, rules: list[Rule], *, url: str = "url", id: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``df``.

    ``rule`` is the name of the longest rule that fits, else NULL; ``verdict`` (allow or block) is the rule's, else that of trees
    fitted on the URLs that rules decide, at most ``FIT_PER_LABEL`` of each label.  If rules decide no URL, or all alike, the others get
    allow, or that verdict.  A NULL URL and one without ``://`` have an empty host and path and go through the same trees (a NULL as
    an empty text).  Repeated rows get the same answer; an empty table gives no rows; other columns are not looked at.
    """
    address = F.coalesce(F.col(url), F.lit(""))
    rows = df.select(F.col(id).alias("id"), address.alias("url"), host_of(address).alias("host"), path_of(address).alias("path"))
    rows = rows.withColumn("hit", rule_hit(F.col("host"), F.col("path"), rules))
    rows = rows.select("*", *(c.alias(n) for n, c in _suffixes(F.col("host")).items()))
    known = F.when(F.col("hit.verdict") == "block", 1.0).when(F.col("hit").isNotNull(), 0.0)

    # Suffix statistics over all labelled URLs, one row for each suffix; a hot suffix is summed in tasks first.
    labelled = rows.where(F.col("hit").isNotNull()).select("id", "url", "host", "path", "tld", "domain", known.alias("label"))
    counts = labelled.groupBy("tld", "domain").agg(F.sum("label").alias("blocked"), F.count(F.lit(1)).alias("n"))
    domains = stored(counts, "url-domains")
    totals = domains.agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n")).first()
    if not totals["n"] or totals["blocked"] in (0.0, totals["n"]):
        only = "block" if totals["n"] and totals["blocked"] else "allow"
        return rows.select(F.col("id").alias(id), "host", "path", F.col("hit.name").alias("rule"), F.coalesce("hit.verdict", F.lit(only)).alias("verdict"))
    base = totals["blocked"] / totals["n"]
    by_tld = domains.groupBy("tld").agg(F.sum("blocked").alias("blocked"), F.sum("n").alias("n"))
    by_domain = domains.select("domain", "blocked", "n")

    def described(table: DataFrame, own: bool) -> DataFrame:
        """Rows with features; in fitting, a URL's own label is taken out of its suffix statistics."""
        less = F.lit(1.0) if own else F.lit(0.0)
        label = F.col("label") if own else F.lit(0.0)

        def share(counted: DataFrame, name: str) -> Column:
            blocked, n = F.coalesce(F.col(f"{name}_blocked"), F.lit(0.0)), F.coalesce(F.col(f"{name}_n"), F.lit(0)).cast("double")
            fair = F.when(n > 0, less).otherwise(0.0)
            return (blocked - label * fair + PRIOR * base) / (n - fair + PRIOR)

        joined = table
        for name, counted in (("tld", by_tld), ("domain", by_domain)):
            joined = joined.join(counted.select(name, F.col("blocked").alias(f"{name}_blocked"), F.col("n").alias(f"{name}_n")), name, "left")
        made = features(F.col("url"), F.col("host"), F.col("path"))
        made |= {"tld_blocked_share": share(by_tld, "tld"), "domain_blocked_share": share(by_domain, "domain")}
        keep = [c for c in table.columns if c not in ("tld", "domain")]
        wide = joined.select(*keep, *(F.coalesce(c, F.lit(0.0)).alias(f"f_{n}") for n, c in made.items()))
        return VectorAssembler(inputCols=[f"f_{n}" for n in made], outputCol="features").transform(wide).select(*keep, "features")

    order = F.xxhash64("url", F.lit(23))
    chosen = [labelled.where(F.col("label") == k).orderBy(order, "id").limit(FIT_PER_LABEL) for k in (0.0, 1.0)]
    sample = stored(described(stored(chosen[0].unionByName(chosen[1]), "url-sample"), True).select("features", "label"), "url-features")
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=1, cacheNodeIds=False).fit(sample)
    judged = trees.transform(described(rows, False))
    block = vector_to_array("probability")[1] >= 0.5
    learned = F.when(block, "block").otherwise("allow")
    return judged.select(F.col("id").alias(id), "host", "path", F.col("hit.name").alias("rule"),
                         F.coalesce(F.col("hit.verdict"), learned).alias("verdict"), vector_to_array("probability")[1].alias("block_score"))
