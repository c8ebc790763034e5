"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has a probability for every
piece. A word's probability in a language is the sum, over all ways to cut it into pieces, of
the product of their probabilities; a forward pass along its characters finds it, for many
words and all languages at once. Pieces begin words or lie inside them and never span two, so a
text's probability is the product over its words.

Learning counts the pieces of a sample of labelled documents: those whose id hash falls below
``sample_docs`` / number of labelled documents, so about ``sample_docs`` of them whatever the
size of the corpus. A language of which that would be fewer than ``LEAST_DOCS`` has about that
many instead, or all it has, so every language is learned at every size. Predictions read nothing but the text.

Nulls: a null text, or one without a letter, is ``und`` with score 0; so is every text if there
is nothing to learn from. A null label is not learned from, and rows with a null id count as
held out. Ties go to the alphabetically first language. Repeated rows give repeated rows, an
empty table an empty result; extra columns are not read. Texts are read whole.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import slices

UNKNOWN = "und"
SAMPLE_DOCS = 8_000
#: Documents learned from of each language at least, as far as there are as many.
LEAST_DOCS = 2_000
FOLDS = 5
#: Added to every count.
SMOOTHING = 0.05
#: Log-probability of a character that no piece covers, in every language.
UNCOVERED = np.log(1e-8)
MARK = "▁"
#: Remembered words per worker process; a full memory is emptied.
MEMORY = 600_000
REMEMBERED_CHARS = 48
#: Unicode letters, category L; numerals and symbols are none.
LETTER = regex.compile(r"\p{L}")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept for measuring: crc32 of its id's digits, modulo FOLDS."""
    digits = F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")
    return (F.crc32(digits) % FOLDS == 0) | doc_id.isNull()


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def learn(docs: DataFrame, path: str, sample_docs: int = SAMPLE_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of pieces, shape (pieces, languages).

    Each task adds up its pieces by language; at most languages x pieces rows leave a task and
    reach the driver, whatever the number of documents.
    """
    known = docs.where(~held_out(docs["doc_id"]) & docs["lang"].isNotNull() & docs["text"].isNotNull())
    lang = docs["lang"].cast("string")
    sizes = {r["lang"]: r["count"] for r in known.groupBy(lang.alias("lang")).count().collect()}
    total, limits = sum(sizes.values()), []
    for name, size in sizes.items():
        share = min(1.0, max(sample_docs / total, LEAST_DOCS / size))
        limits += [F.lit(name), F.lit(int(share * (1 << 30)))]
    below = F.element_at(F.create_map(*limits), lang) if limits else F.lit(0)
    chosen = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < below

    def count(batches):
        pieces = processor(path)
        size, counts = pieces.get_piece_size(), {}
        for batch in batches:
            for rows in slices(batch, 64):
                for lang, text in zip(*(c.to_pylist() for c in rows.columns)):
                    ids = pieces.encode(" ".join(text.split()))
                    seen = np.bincount(np.array(ids, dtype=np.int64), minlength=size)
                    counts[lang] = counts[lang] + seen if lang in counts else seen
        for lang, seen in counts.items():
            used = np.flatnonzero(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used), pa.string()), pa.array(used), pa.array(seen[used])],
                ["lang", "piece", "n"],
            )

    sums = (
        known.where(chosen)
        .select(lang, docs["text"].cast("string"))
        .mapInArrow(count, "lang string, piece bigint, n bigint")
        .groupBy("lang", "piece")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    langs = sorted(set(sums.column("lang").to_pylist()))
    table = np.full((processor(path).get_piece_size(), len(langs)), SMOOTHING)
    columns = np.array([langs.index(v) for v in sums.column("lang").to_pylist()], dtype=np.int64)
    np.add.at(table, (sums.column("piece").to_numpy().astype(np.int64), columns), sums.column("n").to_numpy())
    return langs, np.log(table / table.sum(axis=0)) if langs else table


class Scorer:
    """Scores words in all languages and remembers them."""

    def __init__(self, path: str, logs: np.ndarray):
        pieces = processor(path)
        self.logs = np.vstack([logs, np.full((1, logs.shape[1]), UNCOVERED)])
        self.automaton = ahocorasick.Automaton()
        lengths, single = np.ones(len(self.logs), dtype=np.int64), []
        for n in range(pieces.get_piece_size()):
            piece = pieces.id_to_piece(n)
            if pieces.is_control(n) or pieces.is_unknown(n) or pieces.is_byte(n) or not piece:
                continue
            self.automaton.add_word(piece, n)
            lengths[n] = len(piece)
            if len(piece) == 1:
                single.append(ord(piece))
        self.automaton.make_automaton()
        self.lengths, self.single = lengths, np.array(sorted(single), dtype=np.uint32)
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.scores = np.empty((1024, self.logs.shape[1]))

    def forward(self, words: list[str]) -> np.ndarray:
        """Log-probabilities of the words, one row each.

        ``(start, end, piece)`` steps are taken in order of the end's place in its word; by
        then all sums at their starts are complete.
        """
        text = "".join([MARK + w for w in words])
        sizes = np.array([len(w) + 1 for w in words])
        word = np.repeat(np.arange(len(words)), sizes)
        first = np.cumsum(sizes) - sizes
        found = list(self.automaton.iter(text))
        end = np.fromiter((e for e, _ in found), np.int64, len(found))
        piece = np.fromiter((p for _, p in found), np.int64, len(found))
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        bare = np.flatnonzero(~np.isin(points, self.single))
        end = np.concatenate([end, bare])
        piece = np.concatenate([piece, np.full(len(bare), len(self.logs) - 1)])
        start = end - self.lengths[piece] + 1
        inside = start >= first[word[end]]
        start, end, piece = start[inside], end[inside], piece[inside]
        # sums stand before each character and after each word's last one
        source, target = start + word[start], end + word[end] + 1
        level = end - first[word[end]]
        order = np.lexsort((target, level))
        source, target, piece, level = (v[order] for v in (source, target, piece, level))
        sums = np.zeros((len(text) + len(words), self.logs.shape[1]))
        cuts = np.flatnonzero(np.diff(level)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(level)]):
            steps = sums[source[a:b]] + self.logs[piece[a:b]]
            heads = np.concatenate([[0], np.flatnonzero(np.diff(target[a:b])) + 1])
            sums[target[a:b][heads]] = np.logaddexp.reduceat(steps, heads, axis=0)
        return sums[first + np.arange(len(words)) + sizes]

    def remember(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.rows]
        at, need = len(self.rows), len(self.rows) + len(new)
        if need > len(self.scores):
            grown = np.empty((2 * need, self.scores.shape[1]))
            grown[:at] = self.scores[:at]
            self.scores = grown
        for n in range(0, len(new), 4096):
            part = new[n : n + 4096]
            self.scores[at + n : at + n + len(part)] = self.forward(part)
        self.rows.update(zip(new, range(at, need)))

    def texts(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's log-probability in each language. Words that are new to all of them go
        through one forward pass."""
        split = [text.split() for text in texts]
        known = self.rows
        fresh = {w for words in split for w in words if w not in known and len(w) <= REMEMBERED_CHARS}
        if fresh:
            if len(known) + len(fresh) > MEMORY:
                self.clear()
                fresh = {w for words in split for w in words if len(w) <= REMEMBERED_CHARS}
            self.remember(fresh)
        return [self.total(words) for words in split]

    def total(self, words: list[str]) -> np.ndarray:
        """Sum over words, of which the short ones are remembered."""
        try:
            at = np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))
            return self.scores[at].sum(axis=0)
        except KeyError:
            long = [w for w in words if len(w) > REMEMBERED_CHARS]
            rest = self.total([w for w in words if len(w) <= REMEMBERED_CHARS])
            return rest + self.forward(long).sum(axis=0)


SCORERS: dict[tuple[str, int], Scorer] = {}


def scorer(path: str, logs: np.ndarray) -> Scorer:
    """The worker process's scorer of this model; an older model's is let go."""
    key = (path, hash(logs.tobytes()))
    if key not in SCORERS:
        SCORERS.clear()
        SCORERS[key] = Scorer(path, logs)
    return SCORERS[key]


def predict(docs: DataFrame, path: str, langs: list[str], logs: np.ndarray) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): score is the posterior of the best language among
    equally likely ones."""
    names = ["doc_id", "held_out", "lang_pred", "score"]

    def best(scores: np.ndarray) -> tuple[str, float]:
        top = int(np.argmax(scores))
        return langs[top], float(1.0 / np.exp(scores - scores[top]).sum())

    def run(batches):
        known = scorer(path, logs) if langs else None
        for batch in batches:
            for rows in slices(batch, 64):
                texts = [text or "" for text in rows.column(2).to_pylist()]
                found = [(UNKNOWN, 0.0)] * len(texts)
                lettered = [n for n, text in enumerate(texts) if known and LETTER.search(text)]
                if lettered:
                    scores = known.texts([texts[n] for n in lettered])
                    for n, score in zip(lettered, scores):
                        found[n] = best(score)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0),
                        rows.column(1),
                        pa.array([f[0] for f in found], pa.string()),
                        pa.array([f[1] for f in found], pa.float64()),
                    ],
                    names,
                )

    text = docs["text"].cast("string").alias("text")
    return docs.select("doc_id", held_out(docs["doc_id"]).alias("held_out"), text).mapInArrow(
        run, "doc_id bigint, held_out boolean, lang_pred string, score double"
    )
