"""End-to-end run: CSV tables -> ETL -> OLAP, audit, report, chart data, forecasts.

    python -m ledgerflow --csv-dir DIR --out DIR [--master local[8]] [--no-gbt] [--series-key COL]
"""

from __future__ import annotations

import argparse
import os
import sys

from ledgerflow.operators.aggregate import MONTH_KEYS


#: Order of the written aggregates.
SORTED_BY = {"mensile": MONTH_KEYS, "clienti": ("IDS_CUSTOMER",), "articoli": ("IDS_ITEM",)}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerflow")
    ap.add_argument("--csv-dir", required=True, help="folder with the six <TABLE>.csv files")
    ap.add_argument("--out", required=True, help="output folder (any Hadoop-supported path)")
    ap.add_argument("--master", default=None, help="Spark master; default: from the environment")
    ap.add_argument("--no-gbt", action="store_true", help="skip the gradient-boosting model")
    ap.add_argument("--series-key", action="append", default=[], help="forecast one series per value")
    args = ap.parse_args(argv)

    from ledgerflow.operators.forecast import compare_horizons
    from ledgerflow.plans.etl import run_etl
    from ledgerflow.plans.forecast import run_forecast
    from ledgerflow.plans.report import chart_data, statistics_report
    from ledgerflow.session import build_session
    from ledgerflow.sources import load_csv_tables
    from ledgerflow.sources.sinks import write_forecast, write_olap, write_report

    spark = build_session(args.master)
    problems: dict[str, str] = {}
    tables = load_csv_tables(spark, args.csv_dir, problems=problems)
    if tables is None:
        for name, reason in problems.items():
            print(f"ledgerflow: {name}: {reason}", file=sys.stderr)
        return 2
    res = run_etl(tables)
    if res is None:
        print("ledgerflow: expected tables are missing", file=sys.stderr)
        return 2
    out = args.out
    write_olap(res.olap, os.path.join(out, "olap"))
    olap = spark.read.parquet(os.path.join(out, "olap"))     # every analysis reads the stored table
    write_report({"audit": res.audit()}, out)
    write_report(statistics_report({"SALES_OLAP": olap}), os.path.join(out, "report"))
    write_report(chart_data(olap), os.path.join(out, "charts"))
    fc = run_forecast(olap, series_keys=args.series_key, with_gbt=not args.no_gbt)
    write_forecast(fc.export, os.path.join(out, "forecast"))
    write_report({name: df.orderBy(*SORTED_BY[name]) for name, df in fc.aggregates.items() if name in SORTED_BY},
                 os.path.join(out, "aggregates"))
    parts = {"linear_6": fc.linear_6, "separation_date": fc.separation, "horizons": compare_horizons({6: fc.linear_6, 12: fc.linear_12}),
             "linear_metrics": fc.linear_metrics, "linear_coefficients": fc.linear_coefficients,
             "linear_12": fc.linear_12, "gbt_metrics": fc.gbt_metrics, "gbt_importance": fc.gbt_importance,
             "gbt_6": fc.gbt_6}
    if fc.comparison is not None:
        parts["compare_models"] = fc.comparison
    write_report(parts, os.path.join(out, "models"))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
