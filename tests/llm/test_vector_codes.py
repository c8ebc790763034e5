"""Vector codes against a plain version of the rounds, and odd rows."""

import hashlib
import math

import pytest
from compare import connect, duck_rows, spark_rows

from adlake.llm import vector_codes
from adlake.llm.oracles import op11
from adlake.llm.vector_codes import ENTRIES, PARTS, ROUNDS

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, entry int, part int"


def plain(rows, parts=PARTS, entries=ENTRIES, rounds=ROUNDS):
    """{vec_id: (code, error)}, label errors and codebooks digest, in plain Python."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    width = len(kept[0][1]) // parts
    cut = [
        [[math.floor(4096 * x) for x in r[1][p * width : (p + 1) * width]] for p in range(parts)]
        for r in kept
    ]
    first = sorted(range(len(kept)), key=lambda n: kept[n][0])[:entries]
    books = [[list(cut[n][p]) for n in first] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            owned = {}
            for row in cut:
                owned.setdefault(near(row[p], books[p])[1], []).append(row[p])
            for e, members in owned.items():
                books[p][e] = [sum(c) // len(members) for c in zip(*members)]
    out, labels = [], {}
    for r, row in zip(kept, cut):
        best = [near(row[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in best)
        labels[r[2]] = labels.get(r[2], 0) + error
        out.append((r[0], "".join(f"{e:02x}" for _, e in best), error, r[2]))
    text = ",".join(str(c) for book in books for entry in book for c in entry)
    digest = hashlib.sha256(text.encode()).hexdigest()
    return sorted((i, code, error, labels[label], digest) for i, code, error, label in out)


def found(df):
    columns = ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_equals_the_plain_rounds(spark):
    rows = [
        (n, [((n * 37 + c * 11) % 97 - 48) / 40 for c in range(16)], n % 3 if n % 5 else None)
        for n in range(120)
    ]
    rows += [(200, None, 1), (201, [float("nan")] * 16, 1), (202, [None] + [0.0] * 15, 1)]
    rows += [(203, [float("inf")] * 16, 2), (204, [1.0] * 8, 2), (205, [], 2)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    good = [r for r in rows if r[0] < 200]
    stored = spark.createDataFrame([(*r, "x", 1, 2) for r in good], SCHEMA)
    exact = [tuple(r) for r in stored.select("vec_id", "embedding", "label").collect()]
    assert found(vector_codes.compress(df)) == plain(exact)


def test_repeated_rows_count_and_null_ids_come_last(spark):
    rows = [(1, [0.5] * 8, 1)] * 5 + [(None, [0.25] * 8, None), (2, [-0.5] * 8, 1), (None, [0.25] * 8, None)]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)
    result = vector_codes.compress(df, rounds=2)
    codes = {r["vec_id"]: r["code"] for r in result.collect()}
    assert codes == {1: "00" * 8, 2: "01" * 8, None: "02" * 8}
    assert result.count() == 8
    assert {r[0] for r in result.select("error", "label_error").collect()} == {0}


def test_large_components_stop_and_empty_tables_give_nothing(spark):
    df = spark.createDataFrame([(1, [3e38] * 8, 1, "x", 1, 2), (2, [-3e38] * 8, 1, "x", 1, 2)], SCHEMA)
    assert [r["error"] for r in vector_codes.compress(df).collect()] == [0, 0]
    nothing = vector_codes.compress(df.where("false"))
    assert nothing.count() == 0 and nothing.columns == vector_codes.compress(df).columns


def test_only_changed_members_are_shuffled(spark, tmp_path):
    """A second round over settled members moves none, and residents keep their files."""
    df = spark.createDataFrame([(n, [float(n % 4)] * 8, 1, "x", 1, 2) for n in range(64)], SCHEMA)
    kept, length, count = vector_codes.usable(df, PARTS)
    assert (length, count) == (8, 64)
    books = vector_codes.starting_books(kept, PARTS, 4)
    state = vector_codes.staged(
        vector_codes.placed(vector_codes.first_members(kept, books), 2), "members"
    )
    after, (checked, movers) = vector_codes.migrated(state, books, 2)
    assert movers.count() == 0 and checked.count() == after.count() == 64 * PARTS
    plan = vector_codes.assigned(state, books)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.mark.parametrize("scale", ["sf0.001"])
def test_equals_the_sql(spark, scale):
    from adlake.llm.queries import QUERIES

    folder = f"/root/testdata/{scale}"
    mine = spark_rows(QUERIES["op11_member_lloyd"](spark, folder))
    assert mine == duck_rows(connect(folder), op11())
