"""URL filters: rules by host and path, and boosted trees for what no rule fits.

The trees look at the text of a URL alone: lengths, depth, shares of digits and
capitals, entropy of its characters, parameters, and how often URLs of the same
host suffix, or of the same first part of the path, are blocked. They learn from the URLs that a rule decides. All of it
is built-in expressions and the JVM's own tree learner, no Python on the workers.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from editpulse.llm import exchange

TRAINING_URLS = 20_000
BUCKETS = 4096
TREES, DEPTH, SEED = 10, 4, 7

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = (
    "length", "host_length", "path_length", "depth", "dots", "hyphens", "digits", "capitals", "entropy",
    "parameters", "fragment", "secure", "suffix_blocked", "suffix_known", "part_blocked", "part_known",
)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host and all its subdomains, where the path starts like this."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return f"{self.host}{self.path}"

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit(f".{self.host}"))
        return host & F.startswith(F.col("path"), F.lit(self.path))


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """Host in small letters, path, and what follows; empty without a ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    part = lambda pattern: F.coalesce(F.regexp_extract(rest, pattern, 1), F.lit(""))
    host = F.translate(part(r"^([^/?#]*)"), _UPPER, _LOWER)
    return host, part(r"^[^/?#]*([^?#]*)"), part(r"^[^?#]*([\s\S]*)$")


def _matched(rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, null where none does."""
    text = verdict = None
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text), reverse=True):
        text = F.when(rule.fits(), rule.text) if text is None else text.when(rule.fits(), rule.text)
        verdict = F.when(rule.fits(), rule.verdict) if verdict is None else verdict.when(rule.fits(), rule.verdict)
    none = F.lit(None).cast("string")
    return (none, none) if text is None else (text, verdict)


def _share(text: Column, characters: str) -> Column:
    """Share of these characters in a text."""
    left = F.length(F.translate(text, characters, ""))
    return 1 - left / F.greatest(F.length(text), F.lit(1))


def _count(text: Column, character: str) -> Column:
    return F.length(text) - F.length(F.translate(text, character, ""))


def _entropy(letters: str) -> Column:
    """Bits per character, by how often each occurs, of a column of characters."""
    size = F.greatest(F.size(letters), F.lit(1))
    often = F.transform(F.array_distinct(letters), lambda c: F.size(F.filter(letters, lambda x: x == c)).cast("double"))
    return F.log2(size) - F.aggregate(often, F.lit(0.0), lambda sum_, n: sum_ + n * F.log2(n)) / size


def _with_features(rows: DataFrame) -> DataFrame:
    url = F.coalesce("url", F.lit(""))
    suffix = F.element_at(F.split("host", r"\."), -1)
    # A column of its own: within the lambda it would be split anew for every character.
    rows = rows.withColumn("letters", F.array_remove(F.split(url, ""), ""))
    numbers = {
        "length": F.length(url),
        "host_length": F.length("host"),
        "path_length": F.length("path"),
        "depth": F.size(F.filter(F.split("path", "/"), lambda part: part != "")),
        "dots": _count(F.col("host"), "."),
        "hyphens": _count(url, "-"),
        "digits": _share(url, "0123456789"),
        "capitals": _share(url, _UPPER),
        "entropy": _entropy("letters"),
        "parameters": _count(F.col("tail"), "=") + _count(F.col("tail"), "&"),
        "fragment": F.contains("tail", F.lit("#")).cast("int"),
        "secure": F.startswith(url, F.lit("https")).cast("int"),
    }
    rows = rows.withColumns({name: value.cast("double") for name, value in numbers.items()}).drop("letters")
    part = F.split_part(F.col("path"), F.lit("/"), F.lit(2))
    bucket = lambda text: F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int")
    return rows.withColumns({"suffix": bucket(suffix), "part": bucket(part) + BUCKETS})


def _with_blocked(rows: DataFrame) -> DataFrame:
    """How often a rule blocks URLs of the same suffix, and of the same first part of the path.

    A URL's own label stays out of what it learns from.
    """
    known = rows.filter(F.col("label").isNotNull()).select("label", F.explode(F.array("suffix", "part")).alias("bucket"))
    counts = known.groupBy("bucket").agg(F.sum("label").alias("blocked"), F.count("*").alias("seen"))
    # Twice BUCKETS rows at most.
    counts = exchange.stored(counts, "url-counts")
    for name in ("suffix", "part"):
        side = counts.select(F.col("bucket").alias(name), "blocked", "seen")
        rows = rows.join(F.broadcast(side), name, "left")
        blocked = F.coalesce("blocked", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
        seen = F.coalesce("seen", F.lit(0)) - F.col("label").isNotNull().cast("int")
        rows = rows.withColumns({f"{name}_blocked": (blocked + 1) / (seen + 2), f"{name}_known": F.log1p(seen)})
        rows = rows.drop("blocked", "seen")
    return rows


def _sample(rows: DataFrame, drawn: DataFrame, known: dict[float, int]) -> DataFrame:
    """A row for each URL that is trained on, ``TRAINING_URLS`` at most, with ``weight``."""
    parts = []
    for label, n in known.items():
        take = min(n, max(TRAINING_URLS // 2, TRAINING_URLS - known[1.0 - label]))
        part = drawn.filter(F.col("label") == label).orderBy("draw").limit(take)
        parts.append(part.withColumn("weight", F.col("weight") * (n / take)))
    return rows.join(F.broadcast(parts[0].unionByName(parts[1])), ["label", "draw"]).dropDuplicates(["label", "draw"])


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule`` and ``verdict`` of every URL.

    The longest rule that fits decides; ties go to the greater text. Other URLs
    go by trees that were trained on at most ``TRAINING_URLS`` of the distinct URLs
    that a rule decides: half of them of each verdict, more where the other has
    fewer, in order of a hash, weighed by their copies and by how many of a verdict
    each stands for; suffixes and parts are counted over all of them.
    Where rules decide nothing, or all the same, there is nothing to learn and
    other URLs get that verdict, or "allow".

    A null URL, or one without ``://``, has an empty host and path and is judged
    by its text alone. Repeated rows are judged alike. Other columns are ignored,
    an empty table gives an empty one.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    host, path, tail = split_url(F.col("url"))
    rows = rows.withColumns({"host": host, "path": path, "tail": tail})
    rule, decided = _matched(rules)
    rows = _with_features(rows.withColumns({"rule": rule, "decided": decided}))
    rows = rows.withColumn("label", F.when(F.col("decided") == "block", 1.0).when(F.col("decided") == "allow", 0.0))
    rows = rows.drop("tail")

    draw = F.xxhash64("url").alias("draw")
    drawn = rows.filter(F.col("label").isNotNull()).groupBy("label", draw).agg(F.count("*").cast("double").alias("weight"))
    drawn = exchange.stored(drawn, "url-draws")
    known = dict(drawn.groupBy("label").count().collect())
    rows = _with_blocked(rows)
    if len(known) < 2:
        guess = F.lit("block" if 1.0 in known else "allow")
    else:
        sample = exchange.stored(_sample(rows.select("label", draw, *FEATURES), drawn, known), "url-sample")
        vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
        learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight")
        model = learner.fit(vector.transform(sample.orderBy("draw", "label").coalesce(1)))
        rows = model.transform(vector.transform(rows))
        guess = F.when(F.col("prediction") == 1.0, "block").otherwise("allow")
    verdict = F.coalesce("decided", guess).alias("verdict")
    return rows.select(F.col("id").alias(id_col), "host", "path", "rule", verdict)
