"""python -m quirewise QUERY TABLES [--apply FOLDER]: without --apply nothing is computed but the plan."""

from __future__ import annotations

import argparse
import json

from quirewise.session import local_session


def main(arguments: list[str] | None = None) -> int:
    """Run one registered query over a folder of tables: a dry run prints the columns and the plan's size, --apply writes Parquet, if the folder isn't there,
    and prints the rows."""
    from quirewise.plans import registry

    parser = argparse.ArgumentParser(prog="quirewise", description=__doc__)
    parser.add_argument("query", choices=sorted(registry.QUERIES))
    parser.add_argument("tables")
    parser.add_argument("--apply", metavar="FOLDER")
    given = parser.parse_args(arguments)
    spark = local_session()
    df = registry.QUERIES[given.query](spark, given.tables)
    out = {"query": given.query, "columns": df.columns, "dry_run": given.apply is None}
    if given.apply:
        df.write.mode("errorifexists").parquet(given.apply)
        out["rows"] = spark.read.parquet(given.apply).count()
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
