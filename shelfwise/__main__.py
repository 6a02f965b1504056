"""Command line: load the reference's CSV files, run a query, refresh a table.

    python -m shelfwise load  --master M.csv --transactions T.csv --warehouse DIR
    python -m shelfwise query q4_quarter_pivot --warehouse DIR [--year 2019] [--show 20 | --out DIR]
    python -m shelfwise query q2_rollup_compat --warehouse DIR --supplier NAME --year 2019
    python -m shelfwise query q7_line --warehouse DIR --store NAME [--by-year]
    python -m shelfwise query q9_line --warehouse DIR --year 2019 --k 5
    python -m shelfwise stream --landing DIR --warehouse DIR [--stream NAME] [--files-per-batch 10]
    python -m shelfwise stream-master --landing DIR --warehouse DIR [--multiline]
    python -m shelfwise refresh q8_supplier_month_mv --warehouse DIR --table DIR
    python -m shelfwise refresh-all --warehouse DIR --tables DIR

``--master``/``--transactions`` may be files or folders.  ``stream`` drains a folder of
transaction files into a loaded warehouse, ``stream-master`` one of master files; run
them again when more files have landed or after a reload.  The session is the
one ``spark-submit`` provides (or local[*] when run directly); set
``spark.checkpoint.dir`` to a shared folder on a cluster.
"""

from __future__ import annotations

import argparse
import inspect
import json
import sys

from pyspark.sql import SparkSession

from .plans import queries as Q
from .plans.aggregates import AggregateTable, refresh_all
from .plans.catalog import OLAP
from .plans.load import load_csv_warehouse
from .plans.warehouse import WarehouseStar
from .session import DEFAULT_CONF, ensure_checkpoint_dir
from .streaming.warehouse import audit_totals, stream_into_warehouse, stream_master_into_warehouse

QUERY_NAMES = list(OLAP)
# command line option -> parameter of the query
QUERY_OPTIONS = {"year": "year", "supplier": "supplier_name", "store": "store_name", "k": "k",
                 "by_year": "by_year"}
# stored aggregate tables: query -> (group keys, measures)
TABLES = {
    "q6_store_product_mv": (["store_id", "product_id"], ["store_total"]),
    "q6_line": (["store_id", "product_id"], ["store_total"]),
    "q8_supplier_month_mv": (["supplier_id", "supplier_name", "month"], ["monthly_sales"]),
    "q10_entity_month_mv_compat": (["id", "entity_type", "entity_id", "month"],
                                   ["monthly_sales"]),
    "q10_entity_month_mv_line": (["id", "entity_type", "entity_id", "month"],
                                 ["monthly_sales"]),
}


def session() -> SparkSession:
    """The active session, else the one ``spark-submit`` configured (local[*]
    when run with plain python), with the SQL defaults of ``session``."""
    spark = SparkSession.getActiveSession() or \
        SparkSession.builder.appName("shelfwise").getOrCreate()
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def query_options(parser: argparse.ArgumentParser, args) -> dict:
    """The options given on the command line, as parameters of the query."""
    known = inspect.signature(getattr(Q, args.name)).parameters
    out = {}
    for option, name in QUERY_OPTIONS.items():
        value = getattr(args, option)
        if value is None:
            continue
        if name not in known:
            parser.error(f"{args.name} has no --{option.replace('_', '-')}")
        out[name] = int(value) if option == "k" and args.name != "q5_sigma_anomaly" else value
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="shelfwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load", help="CSV files -> warehouse tables")
    ld.add_argument("--master", required=True)
    ld.add_argument("--transactions", required=True)
    ld.add_argument("--warehouse", required=True)
    ld.add_argument("--multiline", action="store_true", help="quoted master fields may hold line breaks")
    for name, of in (("stream", "transaction"), ("stream-master", "master")):
        st = sub.add_parser(name, help=f"drain a folder of {of} files into a warehouse")
        st.add_argument("--landing", required=True)
        st.add_argument("--warehouse", required=True)
        st.add_argument("--stream", default="landing" if name == "stream" else "master",
                        help="name of the stream; each has checkpoints of its own")
        st.add_argument("--files-per-batch", type=int, default=10)
    st.add_argument("--multiline", action="store_true", help="quoted fields may hold line breaks")
    qy = sub.add_parser("query", help="run one OLAP query over a warehouse")
    qy.add_argument("name", choices=QUERY_NAMES)
    qy.add_argument("--warehouse", required=True)
    qy.add_argument("--year", type=int)
    qy.add_argument("--supplier", help="supplier name")
    qy.add_argument("--store", help="store name")
    qy.add_argument("--k", type=float, help="rows of a top-k, or deviations of Q5")
    qy.add_argument("--by-year", action="store_true", default=None,
                    help="keep months of different years apart")
    qy.add_argument("--show", type=int, default=20)
    qy.add_argument("--out", help="write the result as parquet instead of printing")
    rf = sub.add_parser("refresh", help="full refresh of a stored aggregate table")
    rf.add_argument("name", choices=sorted(TABLES))
    rf.add_argument("--warehouse", required=True)
    rf.add_argument("--table", required=True)
    ra = sub.add_parser("refresh-all", help="full refresh of the three stored aggregates")
    ra.add_argument("--warehouse", required=True)
    ra.add_argument("--tables", required=True)
    args = ap.parse_args(argv)
    options = query_options(ap, args) if args.cmd == "query" else {}

    spark = session()
    if args.cmd == "load":
        counts = load_csv_warehouse(spark, args.master, args.transactions, args.warehouse, args.multiline)
        print(json.dumps(counts))
    elif args.cmd in ("stream", "stream-master"):
        into, more = ((stream_into_warehouse, {}) if args.cmd == "stream" else
                      (stream_master_into_warehouse, {"multiline": args.multiline}))
        into(spark, args.landing, args.warehouse, args.files_per_batch, args.stream, **more)
        print(json.dumps(audit_totals(spark, args.warehouse, args.stream)))
    elif args.cmd == "query":
        df = getattr(Q, args.name)(WarehouseStar(spark, args.warehouse), **options)
        if args.out:
            df.write.mode("overwrite").parquet(args.out)
        else:
            df.show(args.show, truncate=False)
    elif args.cmd == "refresh-all":
        print(json.dumps(refresh_all(WarehouseStar(spark, args.warehouse), args.tables)))
    else:
        keys, measures = TABLES[args.name]
        table = AggregateTable(spark, args.table, keys, measures)
        path = table.refresh_full(getattr(Q, args.name)(WarehouseStar(spark, args.warehouse)))
        print(path)
    return 0


if __name__ == "__main__":
    sys.exit(main())
