"""Vector codes by member-resident Lloyd rounds in whole numbers.

Vectors become integers and are cut into equal parts; each part position has a codebook. Every
part is a row that lives with the owner of its (position, entry, salt). A round is two steps:

1. owners sum their resident members, and only the sums (one row per task, position and entry)
   are combined into the new codebooks, which have a fixed size and go to every task;
2. members are assigned anew where they live. Those that keep their entry stay in the files their
   owner wrote; only those that change it go through a shuffle, to their new owner.

The first placement shuffles every part once, the last assignment none. A salt holds about
``OWNED`` members, so an entry with a third of all parts has as many owners as it needs. Each
step is written to the shared folder and the step before it is deleted.

Vectors that are null or hold null or non-finite components are dropped, and so are those whose
length is not the table's most frequent one (of equally frequent ones the longest) among the
positive multiples of the number of parts. Codebooks start with the smallest ids, each once; of
several vectors with one id the smallest serves, and a null id comes last. Fewer ids than entries
make smaller codebooks. Components beyond +-2^27 after scaling (32,768 before) stop there, which
keeps every sum within 64 bits. Repeated rows are coded once each and all count in the sums. An
empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import discard, slices, staged

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LARGEST = 1 << 27
#: Members of one owner, on average.
OWNED = 65_536
SLICE = 8_192
MEMBER = "row bigint, vec_id bigint, label {label}, position tinyint, entry tinyint, part binary"


def usable(vectors: DataFrame, parts: int) -> tuple[DataFrame, int, int]:
    """(row, vec_id, label, embedding) of the vectors that are kept, their length and number."""
    x = vectors["embedding"].cast("array<double>")
    infinite = F.lit(float("inf"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite))
    finite = vectors.select(
        F.monotonically_increasing_id().alias("row"),
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["label"].alias("label"),
        x.alias("embedding"),
        F.size(x).alias("length"),
    ).where(x.isNotNull() & good & (F.size(x) > 0) & (F.size(x) % parts == 0))
    common = (
        finite.groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).first()
    )
    length, count = (common["length"], common["count"]) if common else (0, 0)
    return finite.where(F.col("length") == length).drop("length"), length, count


def scaled(vectors: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * vectors), -LARGEST, LARGEST).astype(np.int64)


def starting_books(kept: DataFrame, parts: int, entries: int) -> np.ndarray:
    """Codebooks (part, entry, component) of the smallest ids."""
    ids = kept.select("vec_id").distinct().orderBy(F.asc_nulls_last("vec_id")).limit(entries)
    wanted = [r[0] for r in ids.collect()]
    among = F.col("vec_id").isin([i for i in wanted if i is not None])
    if None in wanted:
        among = among | F.col("vec_id").isNull()
    chosen = kept.where(among).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    vectors = {r["vec_id"]: r["embedding"] for r in chosen.collect()}
    first = scaled(np.array([vectors[i] for i in wanted], dtype=np.float64))
    return first.reshape(len(wanted), parts, -1).transpose(1, 0, 2)


def nearest(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part; the lowest of equally near entries."""
    apart = np.stack([((part - entry) ** 2).sum(axis=1) for entry in book], axis=1)
    entry = apart.argmin(axis=1)
    return entry, apart[np.arange(len(part)), entry]


def assign(position: np.ndarray, part: np.ndarray, books: np.ndarray):
    """:func:`nearest` for parts of mixed positions."""
    entry = np.zeros(len(part), dtype=np.int64)
    error = np.zeros(len(part), dtype=np.int64)
    for p in np.unique(position):
        at = np.flatnonzero(position == p)
        entry[at], error[at] = nearest(part[at], books[p])
    return entry, error


def as_parts(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<i4").reshape(-1, width).astype(np.int64)


def as_binary(parts: np.ndarray) -> pa.Array:
    data, size = parts.astype("<i4").tobytes(), 4 * parts.shape[1]
    return pa.array([data[n : n + size] for n in range(0, len(data), size)], pa.binary())


def first_members(kept: DataFrame, books: np.ndarray) -> DataFrame:
    """The parts of all vectors with their first entries."""
    parts, _, width = books.shape

    def run(batches):
        for batch in batches:
            for rows in slices(batch, SLICE // parts):
                vectors = rows.column(3).flatten().to_numpy().reshape(rows.num_rows, -1)
                cut = scaled(vectors).reshape(-1, width)
                position = np.tile(np.arange(parts), rows.num_rows)
                entry, _ = assign(position, cut, books)
                owner = pa.array(np.repeat(np.arange(rows.num_rows), parts))
                identity = [rows.column(n).take(owner) for n in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*identity, pa.array(position, pa.int8()), pa.array(entry, pa.int8()), as_binary(cut)],
                    ["row", "vec_id", "label", "position", "entry", "part"],
                )

    return kept.mapInArrow(run, MEMBER.format(label=kept.schema["label"].dataType.simpleString()))


def placed(members: DataFrame, salts: int) -> DataFrame:
    """Members with their owners."""
    salt = F.pmod(F.xxhash64("row"), F.lit(salts))
    return members.repartition(F.col("position"), F.col("entry"), salt)


def updated(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks of the floored means of the residents; an entry without any stays."""
    parts, entries, width = books.shape

    def run(batches):
        sums = np.zeros((parts * entries, width), dtype=np.int64)
        counts = np.zeros(parts * entries, dtype=np.int64)
        for batch in batches:
            for rows in slices(batch, SLICE):
                position, entry = (rows.column(n).to_numpy().astype(np.int64) for n in (0, 1))
                slot, part = position * entries + entry, as_parts(rows.column(2), width)
                np.add.at(sums, slot, part)
                counts += np.bincount(slot, minlength=len(counts))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held), pa.array(counts[held]), pa.array(list(sums[held]), pa.list_(pa.int64()))],
            ["slot", "n", "sums"],
        )

    partial = state.select("position", "entry", "part").mapInArrow(
        run, "slot bigint, n bigint, sums array<bigint>"
    )
    totals = partial.select("slot", "n", F.posexplode("sums").alias("at", "sum"))
    totals = totals.groupBy("slot", "at").agg(F.sum("sum").alias("sum"), F.sum("n").alias("n"))
    books = books.copy()
    # parts x entries x width rows, whatever the table's size.
    for row in totals.collect():
        books[row["slot"] // entries, row["slot"] % entries, row["at"]] = row["sum"] // row["n"]
    return books


def assigned(state: DataFrame, books: np.ndarray) -> DataFrame:
    """Every member where it lives, with its entry under new codebooks, whether that ``moved``
    it, and its distance."""
    width = books.shape[2]

    def run(batches):
        for batch in batches:
            for rows in slices(batch, SLICE):
                position, before = (rows.column(n).to_numpy().astype(np.int64) for n in (3, 4))
                entry, error = assign(position, as_parts(rows.column(5), width), books)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows.column(n) for n in range(4)),
                        pa.array(entry, pa.int8()),
                        rows.column(5),
                        pa.array(error),
                        pa.array(entry != before),
                    ],
                    ["row", "vec_id", "label", "position", "entry", "part", "error", "moved"],
                )

    label = state.schema["label"].dataType.simpleString()
    return state.mapInArrow(run, f"{MEMBER.format(label=label)}, error bigint, moved boolean")


def migrated(state: DataFrame, books: np.ndarray, salts: int) -> tuple[DataFrame, list[DataFrame]]:
    """The next state and what it is stored in: residents as they lie, and the members that
    changed their entry, which alone are shuffled."""
    checked = staged(assigned(state, books).drop("error"), "members", partition="moved")
    stay = checked.where("NOT moved").drop("moved")
    came = staged(placed(checked.where("moved").drop("moved"), salts), "movers")
    return stay.unionByName(came), [checked, came]


def learn(
    kept: DataFrame, count: int, parts: int, entries: int, rounds: int
) -> tuple[DataFrame, np.ndarray]:
    """All members under the codebooks of the last round, and those codebooks."""
    salts = -(-count // OWNED)
    books = starting_books(kept, parts, entries)
    state = staged(placed(first_members(kept, books), salts), "members")
    stored = [state]
    for n in range(rounds):
        books = updated(state, books)
        if n + 1 < rounds:
            state, fresh = migrated(state, books, salts)
            for old in stored:
                discard(old)
            stored = fresh
    return assigned(state, books), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error, codebooks_sha256.

    ``parts`` is at most 8 and ``entries`` at most 128, so that a code fits 64 bits.
    """
    if not (1 <= parts <= 8 and 1 <= entries <= 128):
        raise ValueError("at most 8 parts and 128 entries")
    kept, length, count = usable(vectors, parts)
    if not count:
        nothing = kept.select("vec_id").where("false")
        return nothing.selectExpr(
            "vec_id", "'' AS code", "0L AS error", "0L AS label_error", "'' AS codebooks_sha256"
        )
    members, books = learn(kept, count, parts, entries, rounds)
    place = 8 * (parts - 1 - F.col("position").cast("int"))
    coded = members.groupBy("row").agg(
        F.max("vec_id").alias("vec_id"),
        F.max("label").alias("label"),
        F.bit_or(F.call_function("shiftleft", F.col("entry").cast("long"), place)).alias("bits"),
        F.sum("error").alias("error"),
    )
    coded = staged(coded.drop("row"), "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    totals = totals.withColumnRenamed("label", "of_label")
    code = F.lpad(F.lower(F.hex("bits")), 2 * parts, "0")
    # A label with very many vectors is one row on the right; AQE cuts its rows on the left.
    return coded.join(totals, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id",
        code.alias("code"),
        "error",
        "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"),
    )
