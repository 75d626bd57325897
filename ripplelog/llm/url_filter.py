"""URL filters: rules by host and path, and gradient-boosted trees on what a URL looks like for those that no rule fits."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ripplelog.llm.common import ascii_lower, col, stage, unused

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    """A verdict on a host with all its subdomains, where the path begins with `path`."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "".join(self.text.partition("/")[1:])


def host_of(url: Column) -> Column:
    """What stands behind the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; empty without `://`."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What stands behind the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _suffix(host: Column, names: int) -> Column:
    """The last `names` names of a host, all of it if it has fewer."""
    return F.substring_index(host, ".", -names)


#: Longer lists of rules are joined without being sent to all tasks.
BROADCAST_RULES = 100_000


def with_rule(rows: DataFrame, rules: Iterable[Rule], found: str) -> DataFrame:
    """rows (with host and path) and the longest rule that fits as a struct (length, text, verdict), or null; of equally long
    ones the first by text, then `allow`.

    A rule for a host of n names fits where the last n names are its host, so there is one join for each number of names, on
    equal hosts: rows are not multiplied, and of the rules of one host the longest that fits is taken.
    """
    by_names: dict[int, dict[str, list[Rule]]] = {}
    for r in set(rules):
        by_names.setdefault(r.host.count(".") + 1, {}).setdefault(r.host, []).append(r)
    kind = "struct<path: string, it: struct<length: int, text: string, verdict: string>>"
    best = [F.lit(None).cast("struct<length: int, text: string, verdict: string>")] * 2
    for n, hosts in sorted(by_names.items()):
        known = [(host, sorted((r.path, (-len(r.text), r.text, r.verdict)) for r in of)) for host, of in hosts.items()]
        known = rows.sparkSession.createDataFrame(known, f"_host{n} string, _rules{n} array<{kind}>")
        known = F.broadcast(known) if len(hosts) <= BROADCAST_RULES else known
        rows = rows.join(known, _suffix(F.col("host"), n) == F.col(f"_host{n}"), "left").drop(f"_host{n}")
        best.append(F.array_min(F.transform(F.filter(f"_rules{n}", lambda r: F.col("path").startswith(r["path"])), lambda r: r["it"])))
    return rows.withColumn(found, F.least(*best)).drop(*[f"_rules{n}" for n in by_names])


#: Parts of a URL that have statistics: the last one, two and three names of the host, and the first of the path.
PARTS = ("suffix1", "suffix2", "suffix3", "segment")
PLAIN = ("length", "host_length", "names", "hyphens", "depth", "digit_ratio", "entropy", "parameters")


def _entropy(text: Column) -> Column:
    """Bits a character, from the numbers of the different characters."""
    n = F.char_length(text).cast("double")
    different = F.filter(F.array_distinct(F.split(text, "")), lambda c: c != "")
    shares = F.transform(different, lambda c: (n - F.char_length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n > 0, -F.aggregate(shares, F.lit(0.0), lambda s, k: s + k * F.log2(k))).otherwise(0.0)


def features(rows: DataFrame, url: str = "url", host: str = "host", path: str = "path") -> DataFrame:
    """rows with PLAIN and PARTS; a null url is an empty one. Names are counted between dots, parameters between & and ;."""
    u, h, p = F.coalesce(col(url), F.lit("")), col(host), col(path)
    query = F.regexp_extract(u, r"(?s)\?([^#]*)", 1)
    count = lambda c, pattern: F.regexp_count(c, F.lit(pattern)).cast("double")
    return rows.withColumns(
        {
            "length": F.char_length(u).cast("double"),
            "host_length": F.char_length(h).cast("double"),
            "names": count(h, r"[^.]+"),
            "hyphens": count(h, "-"),
            "depth": count(p, "[^/]+"),
            "digit_ratio": F.coalesce(F.try_divide(count(u, "[0-9]"), F.char_length(u)), F.lit(0.0)),
            "entropy": _entropy(u),
            "parameters": count(query, "[^&;]+"),
            **{f"suffix{i}": _suffix(h, i) for i in (1, 2, 3)},
            "segment": F.regexp_extract(p, "^/?([^/]*)", 1),
        }
    )


@dataclass
class Model:
    """Trees, and for each part of a URL the share of blocked ones among those with the same value."""

    trees: PipelineModel | None
    statistics: dict[str, DataFrame] = field(default_factory=dict)
    usual: float = 0.0

    def with_statistics(self, rows: DataFrame) -> DataFrame:
        """Values that no labelled URL had get the share of all of them."""
        for part, known in self.statistics.items():
            rows = rows.join(known, part, "left").withColumn(f"{part}_share", F.coalesce(f"{part}_share", F.lit(self.usual)))
        return rows


#: The sample is small and read in every round of the training.
SAMPLE_FILES = 6
#: A value's share is drawn to the usual one as if so many further URLs had it.
PRIOR = 5.0


def fit(labelled: DataFrame, rounds: int = 20, depth: int = 4, least: int = 20, values: int = 20_000) -> Model:
    """labelled: features() and blocked (0 or 1). Half of the URLs, by a hash of their text, give the statistics, the other
    half the trees, which so see the statistics as they are for URLs that had no part in them.

    Of each part the `values` most frequent values have statistics, so that what is sent to all tasks is bounded. With fewer
    than `least` URLs of either label there is nothing to learn: no trees.
    """
    numbers = {r.blocked: r["count"] for r in labelled.groupBy("blocked").count().collect()}
    usual = numbers.get(1, 0) / max(1, sum(numbers.values()))
    if min(numbers.get(0, 0), numbers.get(1, 0)) < least:
        return Model(None, usual=usual)
    half = F.xxhash64(F.lit(13), "url") % 2 == 0
    share = (F.sum("blocked") + PRIOR * usual) / (F.count(F.lit(1)) + PRIOR)
    statistics = {}
    for part in PARTS:
        ranked = labelled.where(half).groupBy(part).agg(share.alias(f"{part}_share"), F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), part).limit(values)
        known = [(r[part], r[f"{part}_share"]) for r in ranked.collect()]
        statistics[part] = F.broadcast(labelled.sparkSession.createDataFrame(known, f"{part} string, {part}_share double"))
    model = Model(None, statistics, usual)
    columns = [*PLAIN, *[f"{p}_share" for p in PARTS]]
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(model.with_statistics(labelled.where(~half)).select("blocked", *columns))
    trees = GBTClassifier(labelCol="blocked", maxIter=rounds, maxDepth=depth, seed=13).fit(rows.select("blocked", "features"))
    model.trees = PipelineModel([VectorAssembler(inputCols=columns, outputCol="features"), trees])
    return model


def filter_urls(pages: DataFrame, rules: Iterable[Rule], each: int = 50_000) -> DataFrame:
    """Adds host, path, rule (the text of the longest one that fits, or null) and verdict (allow or block) to every row.

    What no rule fits is judged by trees on its look: lengths, names and hyphens of the host, depth of the path, share of
    digits, entropy, number of parameters, and the share of blocked URLs among those with the same last names of the host
    and the same first name of the path. They learn from the URLs that the rules decide: about `each` different ones, all if there are fewer, of each
    verdict, chosen by a hash. Where the rules leave too few of either to learn from, the rest is allowed.

    A null url, or one without `://`, has an empty host and path, which fit no rule. Repeated rows are judged alike. Columns
    of `pages` called host, path, rule or verdict are replaced, all others stay; an empty table stays empty. Rules are
    joined by the last names of the host; up to BROADCAST_RULES hosts, and the statistics, which are bounded, are sent to all
    tasks, so that the table itself is read and not moved.
    """
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    packed = unused(names, "_row")
    url = F.col("url")
    placed = pages.select(F.struct(*map(col, names)).alias(packed), "url").withColumns({"host": host_of(url), "path": path_of(url)})
    ruled = with_rule(placed, rules, "_found")
    sample = ruled.where("_found IS NOT NULL").select("url", "host", "path", (F.col("_found.verdict") == BLOCK).cast("int").alias("blocked"))
    model = fit(stage(features(_few(sample, each)).coalesce(SAMPLE_FILES)))
    if model.trees is None:
        judged = ruled.withColumn("_said", F.lit(0.0))
    else:
        judged = model.trees.transform(model.with_statistics(features(ruled))).withColumnRenamed("prediction", "_said")
    verdict = F.coalesce("_found.verdict", F.when(F.col("_said") > 0.5, BLOCK).otherwise(ALLOW))
    return judged.select(*[F.col(packed)[c].alias(c) for c in names], "host", "path", F.col("_found.text").alias("rule"), verdict.alias("verdict"))


def _few(labelled: DataFrame, each: int) -> DataFrame:
    """About `each` different URLs of each label, those with the smallest hashes: a threshold on the hash is set by the
    number of different ones, so that nothing else is moved."""
    numbers = {r.blocked: r.n for r in labelled.groupBy("blocked").agg(F.approx_count_distinct("url").alias("n")).collect()}
    hashed, low = F.xxhash64("url"), F.lit(False)
    for value, n in numbers.items():
        low = low | ((F.col("blocked") == value) & (F.abs(hashed / F.lit(2.0**63)) * n <= each))
    return labelled.where(low).dropDuplicates(["url"])
