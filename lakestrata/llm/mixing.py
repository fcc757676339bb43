"""Mixing to target weights with soft domain membership, in DataFrame functions only.

A Bernoulli naive Bayes classifier, learned from the labels table, gives each document a
posterior over domains. Its features are words several times as frequent in one domain as overall;
common words are left out, as they tell languages and lengths apart rather than domains. Document rates in [0, 1] are then fitted by projected gradient steps on

    sum over domains of (expected tokens - target)^2 / (2 * available tokens).

A gradient step needs one residual per domain and moves each rate by a function of the document's
own posterior. So the state between steps is a few numbers on the driver, and any rate
can be computed in its row from the list of past residuals.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Collection
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.layout import materialize

DOMAINS = ("clean", "poor", "toxic")
# Wanted shares of the expected tokens.
TARGETS = {"clean": 0.95, "poor": 0.05, "toxic": 0.0}
# Under these targets no clean text goes because another domain is scarce.
KEPT_WHOLE = "clean"
# The classifier is fitted on at most so many labelled rows, those of smallest hash of doc_id.
TRAINING_ROWS = 20_000
MOST_FEATURES = 256
LEAST_DOCUMENTS = 10
LEAST_PHI2 = 0.003  # squared correlation with a domain
LEAST_CHI2 = 15.0  # the same times the sample's size, which keeps chance out of small samples
LEAST_LIFT = 3.0
STEPS = 24
STEP = 0.9
SHORT = 0.005  # a share this far below its target is logged
CLOSE = 1e-5  # residuals relative to all tokens at which the fit ends

logger = logging.getLogger(__name__)


def domain_of(quality: Column, toxic: Column) -> Column:
    """Domain of a labelled document; null when either verdict is missing."""
    return (
        F.when(quality.isNull() | toxic.isNull(), F.lit(None))
        .when(toxic > 0, "toxic")
        .when(quality > 0, "clean")
        .otherwise("poor")
    )


def words(text: Column) -> Column:
    """Lower-cased words between spaces and newlines; none for a null text."""
    plain = F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("\n"), F.lit(" "))
    return F.array_remove(F.split(plain, " "), "")


def features(distinct: Column, count: Column) -> Column:
    """Distinct words, and as one more word how often words repeat in a text of this length.

    Words with a blank in front cannot clash with words of a text.
    """
    repeats = F.floor(10 * F.size(distinct) / F.greatest(count, F.lit(1)))
    length = F.floor(F.log2(count + F.lit(1)))
    shape = F.concat(F.lit(" repeats "), repeats.cast("string"), F.lit(" length "), length.cast("string"))
    return F.array_append(distinct, shape)


@dataclass(frozen=True)
class DomainModel:
    base: dict[str, float]  # log weight of a document without any known feature
    known: dict[str, tuple[float, ...]]  # what a feature adds, per domain
    labelled: tuple[str, ...] = DOMAINS  # domains with documents in the sample; others have chance posteriors only

    def posteriors(self, feats: Column) -> Column:
        """Array of probabilities in the order of DOMAINS."""
        start = F.array(*[F.lit(self.base[d]) for d in DOMAINS])
        logs = start
        if self.known:
            names = F.lit(list(self.known))
            hits = F.array_intersect(feats, names)
            gains = F.lit([list(v) for v in self.known.values()])
            logs = F.aggregate(
                hits,
                start,
                lambda sums, word: F.zip_with(
                    sums, F.element_at(gains, F.array_position(names, word).cast("int")), lambda a, b: a + b
                ),
            )
        # Binding each array as a lambda's argument keeps it from being computed once per use.
        bind = lambda xs, f: F.transform(F.array(xs), f)[0]
        raised = lambda xs: bind(F.array_max(xs), lambda most: F.transform(xs, lambda x: F.exp(x - most)))
        shares = lambda xs: bind(
            F.aggregate(xs, F.lit(0.0), lambda a, b: a + b), lambda sum_: F.transform(xs, lambda x: x / sum_)
        )
        return bind(bind(logs, raised), shares)


def fit_domains(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DomainModel:
    """Learn from a bounded sample of labelled documents.

    The chosen labels number at most ``rows``, which bounds the broadcast; the model has at most MOST_FEATURES
    features. Labels without doc_id or verdict, and labels of absent documents, are left out before the bound; of
    contradicting labels the worst counts, and of several texts under one doc_id that of smallest hash. Without labelled documents every domain is equally likely.
    """
    order = {d: n for n, d in enumerate(DOMAINS)}
    rank = F.coalesce(*[F.when(F.col("_domain") == d, n) for d, n in order.items()])
    chosen = (
        labels.select("doc_id", domain_of(F.col("quality"), F.col("toxic")).alias("_domain"))
        .where("doc_id IS NOT NULL AND _domain IS NOT NULL")
        .join(docs.select("doc_id"), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.max(rank).alias("domain"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    chosen = materialize(chosen, "mixing-labels")
    listed = words(F.col("text"))
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    train = (
        texts.groupBy("doc_id", "domain").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
        .select("domain", listed.alias("w"))
        .select("domain", F.array_distinct("w").alias("d"), F.size("w").alias("n"))
        .select("domain", features(F.col("d"), F.col("n")).alias("f"))
    )
    train = materialize(train, "mixing-sample")
    sizes = {r["domain"]: r["n"] for r in train.groupBy("domain").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return DomainModel({d: 0.0 for d in DOMAINS}, {})
    n = [sizes.get(k, 0) for k in range(len(DOMAINS))]
    counts = [F.sum((F.col("domain") == k).cast("double")).alias(f"n{k}") for k in range(len(DOMAINS))]
    table = train.select("domain", F.explode("f").alias("word")).groupBy("word").agg(*counts, F.count("*").alias("df"))

    def phi2(k: int) -> Column:
        gap = F.col(f"n{k}") * total - F.col("df") * n[k]
        return gap * gap / (F.col("df") * (total - F.col("df") + 1e-9) * n[k] * (total - n[k]))

    def lift(k: int) -> Column:
        return F.col(f"n{k}") * total / (F.col("df") * n[k])

    split = [k for k in range(len(DOMAINS)) if 0 < n[k] < total]
    if not split:
        return DomainModel({d: math.log((n[k] + 0.5) / (total + 1.5)) for k, d in enumerate(DOMAINS)}, {})
    best = (
        table.where(F.col("df") >= LEAST_DOCUMENTS)
        .withColumn("phi2", F.array_max(F.array(*map(phi2, split))))
        .where((F.col("phi2") >= LEAST_PHI2) & (F.col("phi2") * total >= LEAST_CHI2))
        .where(F.array_max(F.array(*map(lift, split))) >= LEAST_LIFT)
        .orderBy(F.desc("phi2"), "word")
        .limit(MOST_FEATURES)
        .collect()
    )
    base = [math.log((n[k] + 0.5) / (total + 0.5 * len(DOMAINS))) for k in range(len(DOMAINS))]
    known = {}
    for row in best:
        overall = (row["df"] + 0.5) / (total + 1.0)
        chance = [(row[f"n{k}"] + overall) / (n[k] + 1.0) for k in range(len(DOMAINS))]
        known[row["word"]] = tuple(math.log(p / (1 - p)) for p in chance)
        base = [b + math.log(1 - p) for b, p in zip(base, chance)]
    return DomainModel(dict(zip(DOMAINS, base)), known, tuple(d for d, rows_ in zip(DOMAINS, n) if rows_))


def with_posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """All rows of ``docs`` with ``n_tokens`` (words) and ``posteriors``."""
    keep = docs.columns
    counted = docs.withColumn("_words", words(F.col("text")))
    counted = counted.select(*keep, F.array_distinct("_words").alias("_distinct"), F.size("_words").cast("long").alias("n_tokens"))
    feats = features(F.col("_distinct"), F.col("n_tokens"))
    return counted.select(*keep, "n_tokens", model.posteriors(feats).alias("posteriors"))


def _rate(residuals: list[list[float]]) -> Column:
    """A row's rate after one projected step per residual, from rate 1."""
    if not residuals:
        return F.lit(1.0)

    def follow(posteriors: Column) -> Column:
        dot = lambda g: F.aggregate(
            F.zip_with(posteriors, g, lambda p, x: p * x), F.lit(0.0), lambda a, b: a + b
        )
        step = lambda r, g: F.least(F.lit(1.0), F.greatest(F.lit(0.0), r - F.lit(STEP) * dot(g)))
        return F.aggregate(F.lit(residuals), F.lit(1.0), step)

    # A filter on the rate may take the place of the column; bound, the posteriors are still computed once.
    return F.transform(F.array(F.col("posteriors")), follow)[0]


def goals(
    available: list[float], wanted: list[float], whole: str | None, labelled: Collection[str] = DOMAINS
) -> list[float]:
    """Token totals to reach, in the order of DOMAINS; none is above what is available.

    With ``whole``, that domain is kept whole and the others are thinned down to their shares beside
    it; one with less than its share stays whole and falls short. Without, or when ``whole`` has no labels or no
    tokens, the scarcest wanted domain is used up. Domains without labels are left as they are.
    """
    told = [d in labelled for d in DOMAINS]
    sizes = {d: a / w for d, a, w, t in zip(DOMAINS, available, wanted, told) if t and w}
    if not sizes:
        return list(available)
    size = sizes.get(whole) or min(sizes.values())
    return [min(a, size * w) if t else a for a, w, t in zip(available, wanted, told)]


def fit_rates(
    members: DataFrame, targets: dict[str, float], whole: str | None = None, labelled: Collection[str] = DOMAINS
) -> Column:
    """Rate of a row with ``n_tokens`` and ``posteriors`` as a Column of [0, 1].

    Targets are shares of tokens, which become totals by :func:`goals`. Each step aggregates one
    number per domain over all rows of ``members``. A domain that falls short is logged.
    """
    wanted = [float(targets.get(d, 0.0)) for d in DOMAINS]
    if min(wanted) < 0 or not math.isclose(sum(wanted), 1.0, abs_tol=1e-9):
        raise ValueError("targets are nonnegative shares that add up to 1")
    if whole is not None and not targets.get(whole):
        raise ValueError("the domain to keep whole must be wanted")

    def expected(rate: Column) -> list[float]:
        sums = [F.sum(F.col("n_tokens") * rate * F.col("posteriors")[k]) for k in range(len(DOMAINS))]
        return [x or 0.0 for x in members.agg(*[s.alias(f"s{k}") for k, s in enumerate(sums)]).first()]

    available = expected(F.lit(1.0))
    total = sum(available)
    if not total:
        return F.lit(1.0)
    goal = goals(available, wanted, whole, labelled)
    residuals: list[list[float]] = []
    now = available
    for _ in range(STEPS):
        residuals.append([(m - g) / max(a, 1e-9) for m, g, a in zip(now, goal, available)])
        before, now = now, expected(_rate(residuals))
        if max(abs(a - b) for a, b in zip(before, now)) <= CLOSE * total:
            break
    for domain, share, have in zip(DOMAINS, wanted, now):
        if have < (share - SHORT) * sum(now):
            logger.warning("%s falls short: %.4f of the tokens kept, %.4f wanted", domain, have / sum(now), share)
    return _rate(residuals)


def domain_totals(rated: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """Per domain of a rated table: wanted share, available and expected tokens, their share, and
    ``missing``: the tokens by which the domain falls short of its share."""
    sums = [F.sum(F.col("n_tokens") * F.col(f"p_{d}") * x) for d in DOMAINS for x in (F.lit(1.0), F.col("rate"))]
    wide = rated.agg(*[F.coalesce(s, F.lit(0.0)).alias(f"s{k}") for k, s in enumerate(sums)])
    listed = F.array(*[
        F.struct(
            F.lit(d).alias("domain"), F.lit(float(targets.get(d, 0.0))).alias("wanted"),
            F.col(f"s{2 * k}").alias("available"), F.col(f"s{2 * k + 1}").alias("expected"),
        )
        for k, d in enumerate(DOMAINS)
    ])
    whole = sum((F.col(f"s{2 * k + 1}") for k in range(len(DOMAINS))), F.lit(0.0))
    rows = wide.select(F.explode(listed).alias("d"), whole.alias("_whole")).select("d.*", "_whole")
    missing = F.greatest(F.col("wanted") * F.col("_whole") - F.col("expected"), F.lit(0.0))
    return rows.select("*", F.try_divide("expected", "_whole").alias("share"), missing.alias("missing")).drop("_whole")


def mix_to_targets(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, whole: str | None = None
) -> DataFrame:
    """All rows of ``docs`` with ``n_tokens``, ``p_<domain>`` for every domain, and ``rate``: the
    chance with which to keep the row so that expected domain totals come near the targets.

    Without targets, TARGETS hold and KEPT_WHOLE is kept whole. Targets that are given are met as shares, by
    thinning every domain to the scarcest, unless ``whole`` names a domain to keep (see :func:`goals`;
    :func:`domain_totals` tells what falls short). Where the labels give no feature, every rate is 1. A null or empty text has no tokens and the posterior of its empty feature list. Repeated
    rows get equal rates. An empty table gives an empty result. Columns of the added names
    in ``docs`` are refused.
    """
    added = {"n_tokens", "posteriors", "rate", "_words", "_distinct", *(f"p_{d}" for d in DOMAINS)}
    if clash := added & set(docs.columns):
        raise ValueError(f"columns in the way: {sorted(clash)}")
    model, rate, _ = _fitted(docs, labels, targets, whole)
    return _spread(with_posteriors(docs, model), docs.columns, rate)


def rated_members(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, whole: str | None = None
) -> DataFrame:
    """As :func:`mix_to_targets`, without the texts: doc_id and the added columns."""
    _, rate, members = _fitted(docs, labels, targets, whole)
    return _spread(members, ["doc_id"], rate)


def _fitted(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None, whole: str | None
) -> tuple[DomainModel, Column, DataFrame]:
    if targets is None:
        targets, whole = TARGETS, whole or KEPT_WHOLE
    model = fit_domains(docs, labels)
    members = with_posteriors(docs.select("doc_id", "text"), model).drop("text")
    members = materialize(members, "mixing-members")
    # Without a feature all documents look alike, and thinning them out would only lose rows.
    return model, fit_rates(members, targets, whole, model.labelled) if model.known else F.lit(1.0), members


def _spread(rated: DataFrame, columns: list[str], rate: Column) -> DataFrame:
    chances = [F.col("posteriors")[k].alias(f"p_{d}") for k, d in enumerate(DOMAINS)]
    return rated.select(*columns, "n_tokens", *chances, rate.alias("rate"))
