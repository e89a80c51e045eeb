"""Command line: ``python -m larder <job> ...``; sessions are configured by the launcher."""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import SparkSession

from larder.plans.clustering import score_published
from larder.plans.datamart import publish_scaled, scale_jdbc_table
from larder.plans.products import clean_products, load_products_jdbc, load_products_table
from larder.plans.wordcount import count_words
from larder.sinks import publish_parquet, write_csv, write_parquet
from larder.sources import blank_tokens, read_csv, read_tsv


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="larder")
    jobs = parser.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("datamart", help="CSV to published, scaled feature vectors")
    job.add_argument("csv")
    job.add_argument("root")
    job.add_argument("--run-id")
    job.add_argument("--skip-invalid", action="store_true")

    job = jobs.add_parser("clusters", help="k-means sweep over a published dataset")
    job.add_argument("dataset")
    job.add_argument("--output", help="folder for the scores")
    job.add_argument("--ks", type=int, nargs="+", default=list(range(2, 10)), help="numbers of clusters")
    job.add_argument("--features", default="scaled", help="vector column")
    job.add_argument("--seed", type=int, default=42)
    job.add_argument("--timeout", type=float)

    job = jobs.add_parser("scale", help="database table to published, scaled feature vectors")
    job.add_argument("table")
    job.add_argument("root")
    job.add_argument("--url", required=True, help="JDBC address")
    job.add_argument("--columns", nargs="+", help="feature columns; all without it")
    job.add_argument("--partition-column", help="number, date or timestamp that spreads the rows")
    job.add_argument("--split-columns", nargs="+", help="columns that the database counts even parts by")
    job.add_argument("--partitions", type=int, help="tasks that read; 1 needs no column")
    job.add_argument("--run-id")
    job.add_argument("--property", action="append", default=[], metavar="NAME=VALUE")

    job = jobs.add_parser("clean", help="raw product TSV to a clean numeric CSV")
    job.add_argument("tsv")
    job.add_argument("output")
    job.add_argument("--rows", type=int, help="sample size; the whole table without it")
    job.add_argument("--order-by", nargs="+", help="columns that make the sample repeatable")
    threshold = job.add_mutually_exclusive_group()
    threshold.add_argument("--min-present", type=int)
    threshold.add_argument("--min-fraction", type=float)
    job.add_argument("--drop", nargs="*", default=["code"])
    job.add_argument("--partitions", type=int, help="spread the rows of a gzip file")

    job = jobs.add_parser("load", help="product CSV into a table")
    job.add_argument("csv")
    job.add_argument("table")
    job.add_argument("--url", help="JDBC address; the session catalog without it")
    job.add_argument("--load-id", help="name of this load: it is made once, however often it is started")
    job.add_argument("--property", action="append", default=[], metavar="NAME=VALUE")

    job = jobs.add_parser("wordcount", help="word counts of text files")
    job.add_argument("input", nargs="+")
    job.add_argument("--output", help="folder for the counts; shows the first ones without it")
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName(f"larder {args.job}").getOrCreate()
    if args.job == "datamart":
        policy = "skip" if args.skip_invalid else "error"
        print(publish_scaled(spark, args.csv, args.root, handle_invalid=policy, run_id=args.run_id))
    elif args.job == "clusters":
        scores = score_published(
            spark, args.dataset, args.ks, args.features, seed=args.seed, timeout_seconds=args.timeout
        )
        scores.orderBy("k").show(truncate=False)
        if args.output:
            write_parquet(scores, args.output)
    elif args.job == "scale":
        scaled = scale_jdbc_table(
            spark,
            args.url,
            args.table,
            args.columns,
            partition_column=args.partition_column,
            num_partitions=args.partitions,
            split_columns=args.split_columns,
            properties=dict(pair.split("=", 1) for pair in args.property),
        )
        print(publish_parquet(scaled, args.root, args.run_id or uuid.uuid4().hex))
    elif args.job == "clean":
        fraction = args.min_fraction
        if args.min_present is None and fraction is None:
            fraction = 0.3
        raw = read_tsv(spark, args.tsv, partitions=None if args.rows else args.partitions)
        cleaned = clean_products(
            raw,
            sample=args.rows,
            order_by=args.order_by,
            min_present=args.min_present,
            min_fraction=fraction,
            drop=args.drop,
            infer=True,
        )
        write_csv(cleaned, args.output)
    elif args.job == "load":
        rows = blank_tokens(read_csv(spark, args.csv))
        if args.url:
            properties = dict(pair.split("=", 1) for pair in args.property)
            load_products_jdbc(rows, args.url, args.table, properties=properties, load_id=args.load_id)
        else:
            load_products_table(rows, args.table)
    else:
        counts = count_words(spark, args.input)
        if args.output:
            write_parquet(counts, args.output)
        else:
            counts.show(truncate=False)


if __name__ == "__main__":
    main()
