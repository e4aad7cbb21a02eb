"""python -m weftline.plans.cli -d DIR -f FILE.sql: run SQL over the Parquet tables of a folder."""

from __future__ import annotations

import argparse
from pathlib import Path

from weftline.session import local_session


def main(argv: list[str] | None = None) -> int:
    args = argparse.ArgumentParser(description=__doc__)
    args.add_argument("-d", "--dir", required=True)
    args.add_argument("-f", "--file", required=True)
    args.add_argument("-n", "--rows", type=int, default=100)
    args.add_argument("--explain", help="write the formatted plan of the last statement here")
    a = args.parse_args(argv)
    spark = local_session()
    for p in sorted(Path(a.dir).glob("*.parquet")):
        spark.read.parquet(str(p)).createOrReplaceTempView(p.stem)
    df = None
    for statement in filter(str.strip, Path(a.file).read_text().split(";")):
        df = spark.sql(statement)
    if df is not None:
        df.show(a.rows, truncate=False)
        if a.explain:
            Path(a.explain).write_text(df._jdf.queryExecution().explainString(df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
