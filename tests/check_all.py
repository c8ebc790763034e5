"""Run every registered query against its SQL at a scale: ``check_all.py DIR [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import connect, duck_rows, spark_rows  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(sf_dir), contract.oracle_sql(), 0
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            columns, rows = spark_rows(query(spark, sf_dir))
            status, note = "rows only", f"{len(rows)} rows"
            if name in oracles:
                expected_columns, expected = duck_rows(con, oracles[name])
                same = (columns, rows) == (expected_columns, expected)
                status = "ok" if same else "DIFFERS"
                if not same:
                    failed += 1
                    lost = [r for r in expected if r not in set(rows)][:2]
                    extra = [r for r in rows if r not in set(expected)][:2]
                    note += f" / {len(expected)}; {columns} {expected_columns}\n  -{lost}\n  +{extra}"
        except Exception as error:
            failed += 1
            status, note = "ERROR", str(error)[:700]
        print(f"{status:9} {name:26} {time.time() - started:6.1f}s {note}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
