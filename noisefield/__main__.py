"""python -m noisefield run config.ini [--only STAGE ...] [--skip STAGE ...] | init config.ini | check config.ini
| extract INDEX SRC REC PAIR FOLDER [--timestamp T] [--reverse] | dat config.ini TABLE FOLDER [--receivers R ...] [--distance LO HI]"""

from __future__ import annotations

import argparse

from .plans import config


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="noisefield")
    verbs = parser.add_subparsers(dest="verb", required=True)
    for verb, text in (("run", "run the stages"), ("init", "write a configuration with all defaults"), ("check", "read and check a configuration")):
        p = verbs.add_parser(verb, help=text)
        p.add_argument("config")
        if verb == "run":
            p.add_argument("--only", nargs="*")
            p.add_argument("--skip", nargs="*")
    p = verbs.add_parser("extract", help="write one record that a record index names as a file of its own")
    for name in ("index", "src", "rec", "pair", "folder"):
        p.add_argument(name)
    p.add_argument("--timestamp")
    p.add_argument("--reverse", action="store_true")
    for name in ("src_network", "rec_network", "src_location", "rec_location"):
        p.add_argument(f"--{name.replace('_', '-')}")
    p = verbs.add_parser("dat", help="write stacked records as text, two-sided")
    for name in ("config", "table", "folder"):
        p.add_argument(name)
    p.add_argument("--receivers", nargs="*")
    p.add_argument("--distance", nargs=2, type=float, default=(None, None))
    return parser


def _extract(spark, args) -> int:
    """The one record of a pair of stations and components; more or none is an error."""
    from pyspark.sql import functions as F

    from .operators import lookup
    from .sources import record_lookup, sac, tables

    names = {k: getattr(args, k) for k in ("src_network", "rec_network", "src_location", "rec_location")}
    asked = (args.timestamp, args.src, args.rec, args.pair, args.reverse)
    if record_lookup.is_lookup(spark, args.index):
        found = lookup.one(record_lookup.find(spark, args.index, *asked, **names))
    else:
        found = lookup.one(lookup.extract(tables.record_index(spark, tables.found_indexes(spark, args.index)), *asked, **names))
    rows = sac.read_records(found, "record_path", "record_offset", "bytes", carry=("final_pair_path",))
    return sac.write(rows.withColumn("output_path", F.col("final_pair_path")), args.folder).count()


def _dat(spark, args) -> int:
    from pyspark.sql import functions as F

    from .operators import gather
    from .plans.run import Run
    from .sources import sac

    run = Run(spark, config.load(args.config))
    rows = run.records(args.table, "RTZ" if args.table.startswith("rotated") else "ENZ")
    keyed = rows.withColumns({"rec_network": F.col("knetwk"), "rec_station": F.col("kstnm"), "rec_location": F.lit(""), "distance": F.col("dist")})
    rows = gather.select_receivers(keyed, args.receivers, tuple(args.distance)).drop("rec_network", "rec_station", "rec_location", "distance")
    return sac.write_dat(rows, args.folder, run.chain.max_lag).count()


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    if args.verb == "init":
        config.dump(config.RunConfig(sources=[config.Source("data", "{home}/{YYYY}/{station}.{JJJ}.{component}.sac")]), args.config)
        return 0
    if args.verb == "check":
        c = config.load(args.config)
        print(f"{len(c.sources)} sources, {len(c.bands)} bands, stacks {c.stack_flag}")
        return 0
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.verb == "run":
        from .plans.run import Run

        print("done:", *Run(spark, config.load(args.config)).go(args.only, args.skip))
    else:
        print("written:", {"extract": _extract, "dat": _dat}[args.verb](spark, args))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
