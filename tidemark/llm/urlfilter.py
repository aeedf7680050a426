"""URL filters: rules where they fit, gradient-boosted trees elsewhere.

URLs that a rule decides are the labelled ones. Trees learn from their lexical features:
lengths, depth, digits, entropy, parameters, and for every suffix of the host how many
labelled URLs it has and which share of them is blocked.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, staged

ALLOW, BLOCK = "allow", "block"
#: Labelled URLs that the trees are grown on, at most; statistics cover all of them.
TRAINING_ROWS = 20_000
#: Suffixes of this many labels are counted, the host itself too.
SUFFIXES = (1, 2, 3)
#: A suffix's share of blocked URLs starts from the overall share with this weight.
PRIOR = 20.0


@dataclass(frozen=True)
class Rule:
    """Holds for ``host`` and all its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith("host", F.lit("." + self.host))
        return host & F.startswith("path", F.lit(self.path))


RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def parts(url: Column) -> dict[str, Column]:
    """``host``, ``path`` and ``rest`` (all after the path) of a URL; empty without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    behind = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise(F.lit(""))
    return {
        "host": ascii_lower(F.regexp_extract(behind, r"^([^/?#]*)", 1)),
        "path": F.regexp_extract(behind, r"^[^/?#]*([^?#]*)", 1),
        "rest": F.regexp_extract(behind, r"^[^?#]*([\s\S]*)$", 1),
    }


def decide(rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, as a struct of ``rule`` and ``verdict``; else null."""
    chosen = None
    for rule in sorted(rules, key=lambda r: len(r.host + r.path), reverse=True):
        found = F.struct(
            F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict")
        )
        chosen = F.when(rule.fits(), found) if chosen is None else chosen.when(rule.fits(), found)
    nothing = F.lit(None).cast("struct<rule:string,verdict:string>")
    return nothing if chosen is None else chosen.otherwise(nothing)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def entropy(text: Column) -> Column:
    """Bits per character of a text's own distribution of characters; 0 for none."""
    n = F.length(text)

    def term(character: Column) -> Column:
        share = (n - F.length(F.replace(text, character, F.lit("")))) / n
        return -share * F.log2(share)

    terms = F.transform(F.array_distinct(F.regexp_extract_all(text, F.lit(r"[\s\S]"), F.lit(0))), term)
    return F.aggregate(terms, F.lit(0.0), lambda total, t: total + t)


def lexical() -> dict[str, Column]:
    """Features of ``url``, ``host``, ``path`` and ``rest``."""
    url, host, path, rest = map(F.col, ("url", "host", "path", "rest"))
    length = F.greatest(F.length(url), F.lit(1))
    return {
        "url_length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/"),
        "labels": _count(host, r"[^.]+"),
        "digit_ratio": _count(url, r"[0-9]") / length,
        "hyphens": _count(host, "-"),
        "parameters": _count(rest, "="),
        "entropy": entropy(url),
        "host_entropy": entropy(host),
    }


def suffix(labels: int) -> Column:
    """The last ``labels`` labels of the host."""
    return F.substring_index(F.col("host"), ".", -labels)


def suffix_statistics(known: DataFrame) -> dict[int, DataFrame]:
    """For each number of labels, how many of the labelled URLs ``known`` (each once) end in a
    suffix, and how many of those are blocked: one row per suffix, added up where the URLs are."""
    found = {}
    for labels in (*SUFFIXES, 99):
        blocked = F.sum((F.col("decided.verdict") == BLOCK).cast("long"))
        counted = known.groupBy(suffix(labels).alias(f"suffix_{labels}")).agg(
            F.count("*").alias(f"n_{labels}"), blocked.alias(f"blocked_{labels}")
        )
        found[labels] = staged(known.sparkSession, counted, "url-suffixes")
    return found


def described(rows: DataFrame, statistics: dict[int, DataFrame], share: float) -> DataFrame:
    """``rows`` with the number of labelled URLs and the blocked share of each suffix of the
    host; a labelled URL does not count in its own.

    A suffix may have any share of the URLs: Spark broadcasts the statistics if they are small
    and else splits the large side of the join.
    """
    own = F.col("decided").isNotNull().cast("long")
    own_blocked = F.coalesce((F.col("decided.verdict") == BLOCK).cast("long"), F.lit(0))
    for labels, counted in statistics.items():
        name = f"suffix_{labels}"
        rows = rows.withColumn(name, suffix(labels)).join(counted, name, "left")
        n = F.coalesce(F.col(f"n_{labels}"), F.lit(0)) - own
        blocked = F.coalesce(F.col(f"blocked_{labels}"), F.lit(0)) - own_blocked
        rows = rows.withColumns(
            {
                f"count_{labels}": F.log1p(n.cast("double")),
                f"share_{labels}": (blocked + share * PRIOR) / (n + PRIOR),
            }
        ).drop(name, f"n_{labels}", f"blocked_{labels}")
    return rows


class Trees:
    """Gradient-boosted trees grown on labelled URLs, and what their features need."""

    def __init__(self, known: DataFrame, training_rows: int):
        """``known`` are distinct labelled URLs with their ``copies``, of both kinds."""
        n, copies, blocked = known.agg(
            F.count("*"), F.sum("copies"), F.sum(F.col("copies") * _is_blocked().cast("long"))
        ).first()
        self.share = blocked / copies
        self.statistics = suffix_statistics(known)
        self.names = [*lexical()]
        self.names += [f"{kind}_{k}" for k in self.statistics for kind in ("count", "share")]
        spread = F.pmod(F.xxhash64("url"), F.lit(1_000_000))
        part = int(1_000_000 * min(1.0, training_rows / n)) + 1
        sample = self.ready(known.where(spread < F.lit(part))).select(
            "features", _is_blocked().cast("double").alias("label"), "copies"
        )
        trees = GBTClassifier(
            labelCol="label", weightCol="copies", maxIter=15, maxDepth=4, maxBins=32, seed=7
        )
        self.model = trees.fit(sample.withColumn("copies", F.col("copies").cast("double")))

    def ready(self, rows: DataFrame) -> DataFrame:
        assembler = VectorAssembler(inputCols=self.names, outputCol="features")
        return assembler.transform(described(rows, self.statistics, self.share))

    def risk(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the probability of block."""
        judged = self.model.transform(self.ready(rows))
        return judged.withColumn("risk", vector_to_array("probability").getItem(1))


def _is_blocked() -> Column:
    return F.col("decided.verdict") == BLOCK


def _read(pages: DataFrame, key: str, url: str, rules: tuple[Rule, ...]) -> DataFrame:
    """URLs with their parts, features and what the rules say (``decided``)."""
    read = pages.select(F.col(key).alias("key"), F.coalesce(F.col(url), F.lit("")).alias("url"))
    rows = read.select("*", *[c.alias(name) for name, c in parts(F.col("url")).items()])
    features = lexical()
    rows = rows.withColumn("decided", decide(rules)).select(
        "key", "url", "host", "path", "decided", *[c.alias(n) for n, c in features.items()]
    )
    return staged(pages.sparkSession, rows, "urls")


def _labelled(rows: DataFrame) -> DataFrame:
    """Each labelled URL once, with its ``copies``: one that has any share of all rows is one."""
    others = [F.any_value(c).alias(c) for c in rows.columns if c not in ("key", "url")]
    known = rows.where("decided is not null").groupBy("url")
    return staged(rows.sparkSession, known.agg(F.count("*").alias("copies"), *others), "urls-known")


def _one_kind(known: DataFrame) -> float | None:
    """The risk of all URLs where there is nothing to tell apart; else None."""
    n, blocked = known.agg(F.count("*"), F.count_if(_is_blocked())).first()
    return None if 0 < blocked < n else float(n > 0 and blocked == n)


def judge_urls(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """A verdict for every row of ``pages``: ``key``, ``host``, ``path``, ``rule`` (null if
    none fits), ``verdict`` and ``risk`` (the trees' probability of block).

    The longest rule that fits decides; other URLs, null and broken ones too, get the trees'
    verdict. Trees see at most about ``training_rows`` different labelled URLs, those with the
    smallest hashes, each weighed with its number of rows. With labels of one kind that kind is
    the verdict for all, without any label ``allow``. Repeated rows are judged alike. An empty
    table gives an empty result.
    """
    rows = _read(pages, key, url, rules)
    known = _labelled(rows)
    same = _one_kind(known)
    if same is None:
        judged = Trees(known, training_rows).risk(rows)
    else:
        judged = rows.withColumn("risk", F.lit(same))
    learned = F.when(F.col("risk") >= 0.5, F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return judged.select(
        F.col("key").alias(key),
        "host",
        "path",
        F.col("decided.rule").alias("rule"),
        F.coalesce("decided.verdict", learned).alias("verdict"),
        "risk",
    )


def held_out_accuracy(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    rules: tuple[Rule, ...] = RULES,
    folds: int = 5,
    training_rows: int = TRAINING_ROWS,
) -> dict[str, float]:
    """How often trees that have not seen one labelled host in ``folds`` get its URLs right
    (``trees``), beside always giving the more frequent verdict (``constant``)."""
    known = _labelled(_read(pages, key, url, rules))
    apart = F.pmod(F.xxhash64("host"), F.lit(folds)) == 0
    seen = known.where(~apart)
    if _one_kind(seen) is not None:
        raise ValueError("the labelled hosts that are seen have one verdict")
    trees = Trees(seen, training_rows)
    # Their labels are not among the statistics, so they are not taken out of them either.
    tested = known.where(apart).withColumns(
        {"blocked": _is_blocked(), "decided": F.lit(None).cast("struct<rule:string,verdict:string>")}
    )
    right = ((F.col("risk") >= 0.5) == F.col("blocked")).cast("double")
    n, trees_right, blocked = trees.risk(tested).agg(
        F.count("*"), F.avg(right), F.avg(F.col("blocked").cast("double"))
    ).first()
    constant = blocked if trees.share >= 0.5 else 1 - blocked
    return {"urls": n, "trees": trees_right, "constant": constant}
