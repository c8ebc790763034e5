"""Quality classification with site priors, by hierarchical empirical Bayes.

Evidence about a document comes from its text: a logistic model over a few measures of its
characters and words, fitted to a bounded sample of labelled documents. Evidence about its
site comes from all documents: their labels where known, else the model's probability, summed
by path and by host. A host's rate is shrunk toward the corpus rate, a path's toward its
host's, by prior weights estimated from how much hosts (paths) differ beyond chance; a site
with few documents stays near its prior. The posterior adds the text's log-odds against the
corpus rate to the path's log-odds.

Nulls: a null text is empty; null hosts or paths are sites of their own, and so are empty ones.
Labels that are null are not used; several labels of a document are averaged. Without labels of
both kinds the text says nothing and every document is accepted. Repeated rows give repeated
rows, an empty table an empty result. ``accepted`` keeps all columns, whatever their names.

Hosts of any size are summed with partial aggregation. The table of sites is broadcast if it
has at most BROADCAST_SITES rows; beyond that it is joined by a shuffle whose hot keys adaptive
execution splits.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adlake.llm.common import slices, staged

#: Labelled documents the model is fitted to, at most about this many.
TRAIN_DOCS = 20_000
THRESHOLD = 0.5
BROADCAST_SITES = 50_000
RIDGE = 1.0
#: A document's site is judged by the documents of the other folds.
FOLDS = 16
#: Prior weights are kept between these numbers of documents.
LEAST_WEIGHT, MOST_WEIGHT = 1.0, 1e6

#: What a page does not show, its tags and its character references; linear in the page.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
TAG = "<[^<>]*>"
ENTITY = "&#?[A-Za-z0-9]{1,32};"

MEASURES = ("symbols", "capitals", "digits", "bars", "repeats", "top_word", "distinct", "word_chars", "lines", "length")
BYTE = np.arange(256)
UPPER = (BYTE >= 65) & (BYTE <= 90)
LOWER = (BYTE >= 97) & (BYTE <= 122)
DIGIT = (BYTE >= 48) & (BYTE <= 57)
SYMBOL = (BYTE > 32) & (BYTE < 127) & ~UPPER & ~LOWER & ~DIGIT & ~np.isin(BYTE, [ord(c) for c in ".,'-"])


def measures(text: str) -> list[float]:
    """The text's measures, each between 0 and about 1."""
    raw = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(raw):
        return [0.0] * len(MEASURES)
    seen = np.bincount(raw, minlength=256)
    size, letters = len(raw), int(seen[UPPER | LOWER].sum())
    words = text.split()
    count = max(1, len(words))
    kinds: dict[str, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    return [
        seen[SYMBOL].sum() / size,
        seen[UPPER].sum() / max(1, letters),
        seen[DIGIT].sum() / size,
        seen[ord("|")] / count,
        sum(map(eq, words, words[1:])) / count,
        max(kinds.values(), default=0) / count if count >= 20 else 0.0,
        len(kinds) / count,
        min(1.0, size / count / 20),
        min(1.0, int(seen[10]) * 10 / count),
        np.log1p(count) / 12,
    ]


def with_measures(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` and an array column ``name`` of the text's measures."""
    text_at, names = docs.columns.index("text"), [*docs.columns, name]

    def run(batches):
        for batch in batches:
            for rows in slices(batch):
                found = [measures(str(t or "")) for t in rows.column(text_at).to_pylist()]
                column = pa.array(found, pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*rows.columns, column], names)

    schema = docs.select("*", F.array(F.lit(0.0)).alias(name)).schema
    return docs.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    """The text's log-odds are ``bias`` + ``weights`` x measures; ``rate`` is the share of good
    documents the bias assumes."""

    weights: tuple[float, ...]
    bias: float
    rate: float

    def log_odds(self, found: Column) -> Column:
        terms = [found[n] * w for n, w in enumerate(self.weights)]
        return sum(terms, F.lit(self.bias))


SILENT = Model((0.0,) * len(MEASURES), 0.0, 0.5)


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression by Newton steps on standardized measures and a small ridge."""
    if not len(y) or y.min() > 0.5 or y.max() < 0.5:
        return SILENT
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    ridge = np.diag([RIDGE] * x.shape[1] + [1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    weights = w[:-1] / scale
    return Model(tuple(map(float, weights)), float(w[-1] - weights @ mean), float(y.mean()))


def logit(p: Column) -> Column:
    safe = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(safe / (1 - safe))


def logistic(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.least(F.greatest(x, F.lit(-30.0)), F.lit(30.0))))


def known_labels(labels: DataFrame) -> DataFrame:
    """(id, label): the mean label of each document."""
    return labels.groupBy(labels["doc_id"].alias("id")).agg(
        F.avg(labels["quality"].cast("double")).alias("label")
    ).where("label IS NOT NULL AND id IS NOT NULL")


def evidence(docs: DataFrame, labels: DataFrame, host: str, path: str) -> DataFrame:
    """(id, host, path, found, label), staged: the narrow rows everything else reads."""
    narrow = docs.select(
        docs["doc_id"].alias("id"),
        F.coalesce(docs[host].cast("string"), F.lit("")).alias("host"),
        F.coalesce(docs[path].cast("string"), F.lit("")).alias("path"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    found = with_measures(narrow, "found").drop("text")
    return staged(found.join(known_labels(labels), "id", "left"), "evidence")


def train(rows: DataFrame, train_docs: int = TRAIN_DOCS) -> Model:
    """Fits the model to labelled rows whose id hash falls below the wanted share."""
    labelled = rows.where("label IS NOT NULL")
    total = labelled.count()
    share = min(1.0, train_docs / total) if total else 0.0
    chosen = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))
    sample = labelled.where(chosen).orderBy("id").select("found", "label").toArrow()
    x = np.array(sample.column("found").to_pylist(), dtype=float).reshape(-1, len(MEASURES))
    return fit(x, sample.column("label").to_numpy())


def prior_weight(rates: DataFrame) -> float:
    """The documents a prior counts for, from (n, good, prior) rows: the spread of the rates
    around their priors beyond what ``n`` draws would show."""
    n, rate, prior = F.col("n"), F.col("good") / F.col("n"), F.col("prior")
    chance = prior * (1 - prior)
    row = rates.agg(
        F.sum(n * (rate - prior) ** 2).alias("spread"),
        F.sum(chance).alias("by_chance"),
        F.sum(n).alias("n"),
        F.avg(chance).alias("chance"),
    ).first()
    if not row["n"]:
        return MOST_WEIGHT
    between = (row["spread"] - row["by_chance"]) / row["n"]
    if between <= 0:
        return MOST_WEIGHT
    return float(np.clip(row["chance"] / between - 1, LEAST_WEIGHT, MOST_WEIGHT))


def fold_of(doc_id: Column, folds: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(folds)).cast("int")


def shrunk(weight: float, prior: Column, n: Column, good: Column) -> Column:
    return (good + weight * prior) / (n + weight)


def elsewhere(sums: DataFrame, keys: list[str], folds: int) -> list[Column]:
    """n and good of the other folds under ``keys``, of which a key has at most ``folds`` rows;
    with one fold those of the whole."""
    whole = Window.partitionBy(*keys)
    if folds == 1:
        return [F.sum(c).over(whole).alias(f"other_{c}") for c in ("n", "good")]
    return [
        F.greatest(F.sum(c).over(whole) - F.col(c), F.lit(0)).alias(f"other_{c}")
        for c in ("n", "good")
    ]


def sites(rows: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """(host, path, fold, host_rate, path_rate), staged: the shrunk share of good documents among
    those of the other folds. Prior weights come from all folds."""
    good = F.coalesce(F.col("label"), logistic(model.log_odds(F.col("found"))))
    n_and_good = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    parts = staged(
        rows.groupBy("host", "path", fold_of(F.col("id"), folds).alias("fold")).agg(
            F.count(F.lit(1)).alias("n"), F.sum(good).alias("good")
        ),
        "parts",
    )
    corpus = {r["fold"]: (r["n"], r["good"]) for r in parts.groupBy("fold").agg(*n_and_good).collect()}
    n, total = (sum(v[k] for v in corpus.values()) for k in (0, 1))
    rate = total / n if n else 0.5

    hosts = parts.groupBy("host").agg(*n_and_good)
    host_weight = prior_weight(hosts.withColumn("prior", F.lit(rate)))
    paths = parts.groupBy("host", "path").agg(*n_and_good)
    priors = hosts.select(
        "host", shrunk(host_weight, F.lit(rate), F.col("n"), F.col("good")).alias("prior")
    )
    path_weight = prior_weight(paths.join(priors, "host"))

    rates = [F.lit(rate)] * folds
    for fold, (own_n, own_good) in corpus.items():
        if own_n < n:
            rates[fold] = F.lit((total - own_good) / (n - own_n))
    other_n, other_good = F.col("other_n"), F.col("other_good")
    by_host = parts.groupBy("host", "fold").agg(*n_and_good)
    host_rates = by_host.select("host", "fold", *elsewhere(by_host, ["host"], folds)).select(
        "host",
        "fold",
        shrunk(host_weight, F.array(*rates)[F.col("fold")], other_n, other_good).alias("host_rate"),
    )
    by_path = parts.select("host", "path", "fold", *elsewhere(parts, ["host", "path"], folds))
    path_rate = shrunk(path_weight, F.col("host_rate"), other_n, other_good)
    return staged(
        by_path.join(host_rates, ["host", "fold"]).select(
            "host", "path", "fold", "host_rate", path_rate.alias("path_rate")
        ),
        "sites",
    )


def sized(table: DataFrame) -> DataFrame:
    """The sites with a broadcast hint if there are few enough of them."""
    return F.broadcast(table) if table.count() <= BROADCAST_SITES else table


def posterior(model: Model, found: Column, rate: Column) -> Column:
    against = float(np.log(model.rate / (1 - model.rate)))
    return logistic(model.log_odds(found) - against + logit(rate))


def accepts(model: Model, quality: Column, threshold: float) -> Column:
    """A model that learned nothing rejects nothing."""
    return F.lit(True) if model == SILENT else quality >= threshold


def classify(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    threshold: float = THRESHOLD,
    model: Model | None = None,
) -> DataFrame:
    """One row per document: doc_id, text_quality, host_rate, path_rate, quality, accepted.

    Without ``model`` one is fitted to the documents' own labels.
    """
    rows = evidence(docs, labels, host, path)
    model = model or train(rows)
    quality = posterior(model, F.col("found"), F.col("path_rate"))
    return (
        rows.withColumn("fold", fold_of(F.col("id"), FOLDS))
        .join(sized(sites(rows, model)), ["host", "path", "fold"])
        .withColumn("quality", quality)
        .select(
            F.col("id").alias("doc_id"),
            logistic(model.log_odds(F.col("found"))).alias("text_quality"),
            "host_rate",
            "path_rate",
            "quality",
            accepts(model, F.col("quality"), threshold).alias("accepted"),
        )
    )


def accepted(
    docs: DataFrame,
    labels: DataFrame,
    host: str = "source",
    path: str = "lang",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of accepted documents with all their columns. Texts are measured again rather
    than stored, so that no text is shuffled or written besides the result."""
    rows = evidence(docs, labels, host, path)
    model = train(rows)
    table = sites(rows, model)
    packed = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("row"),
        F.coalesce(docs[host].cast("string"), F.lit("")).alias("host"),
        F.coalesce(docs[path].cast("string"), F.lit("")).alias("path"),
        fold_of(docs["doc_id"], FOLDS).alias("fold"),
        F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"),
    )
    quality = posterior(model, F.col("found"), F.col("path_rate"))
    return (
        with_measures(packed, "found")
        .join(sized(table), ["host", "path", "fold"])
        .where(accepts(model, quality, threshold))
        .select("row.*")
    )


def page_documents(pages: DataFrame) -> DataFrame:
    """(doc_id, text, host, path) of web pages: the text between tags, the URL's host in small
    letters and the first step of its path. A script or style that is never closed runs to the
    end. A URL that is null or none has the empty host and path."""
    html = F.coalesce(pages["html"].cast("string"), F.lit(""))
    for pattern in (HIDDEN, TAG, ENTITY):
        html = F.regexp_replace(html, pattern, " ")
    part = {
        name: F.coalesce(F.try_parse_url(pages["url"].cast("string"), F.lit(name)), F.lit(""))
        for name in ("HOST", "PATH")
    }
    return pages.select(
        pages["page_id"].alias("doc_id"),
        html.alias("text"),
        F.lower(part["HOST"]).alias("host"),
        F.split_part(part["PATH"], F.lit("/"), F.lit(2)).alias("path"),
    )


def classify_pages(
    pages: DataFrame, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per page: page_id, then as :func:`classify`. The model is fitted to labelled
    documents; a page's site is the host and path of its URL, judged by the other pages."""
    known = docs.join(known_labels(labels), docs["doc_id"] == F.col("id"), "left_semi")
    model = train(evidence(known, labels, "source", "lang"))
    unknown = labels.where("false")
    found = classify(page_documents(pages), unknown, "host", "path", threshold, model)
    return found.withColumnRenamed("doc_id", "page_id")
