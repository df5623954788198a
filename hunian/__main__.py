"""Run one job of a batch: ``spark-submit`` this package or ``python -m hunian``."""

from __future__ import annotations

import argparse

from .operators.pages import Site
from .plans.batch import run_batch
from .plans.clean import clean_page
from .plans.count import count_districts
from .plans.extract import extract_page, index_titles
from .plans.store import Store, adopt_csv_tree
from .session import session
from .sources.pages import read_pages
from .streaming.progress import init_progress


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="hunian", description=__doc__)
    parser.add_argument("job", choices=["init", "adopt", "index", "extract", "count", "clean", "batch"])
    parser.add_argument("--root", required=True, help="folder of the tables")
    parser.add_argument("--pages", help="Parquet table of url and html")
    parser.add_argument("--places", help="Parquet table of places")
    parser.add_argument("--base-url", help="address of the listing site")
    parser.add_argument("--country", default="Indonesia")
    parser.add_argument("--raw-format", choices=["parquet", "csv"], default="parquet")
    parser.add_argument("--clean-format", choices=["parquet", "csv"], default="parquet")
    parser.add_argument("--version", help="column of the pages that grows with every fetch of a url")
    parser.add_argument("--titles", help="folder of a title store, which index fills from the stored listings", default="")
    parser.add_argument("--adopt-from", help="folder of a CSV tree that adopt copies")
    parser.add_argument("--allow-whole", action="store_true", help="prices without a decimal part count")
    parser.add_argument("--exact-labels", action="store_true", help="labels must match as a whole")
    parser.add_argument("--whole-value", action="store_true", help="tag patterns must match a whole tag")
    args = parser.parse_args(argv)
    needs = {"adopt": ["adopt_from"], "index": ["titles"], "extract": ["pages", "base_url"], "count": ["places"], "batch": ["pages", "places", "base_url"]}
    for name in needs.get(args.job, []):
        if not getattr(args, name):
            parser.error(f"{args.job} needs --{name.replace('_', '-')}")

    spark = session()
    store = Store.under(args.root, raw_format=args.raw_format, clean_format=args.clean_format, titles=args.titles)
    pages = read_pages(spark, args.pages, args.version) if args.pages else None
    site = Site(args.base_url, exact_labels=args.exact_labels) if args.base_url else None
    places = spark.read.parquet(args.places) if args.places else None
    jobs = {
        "init": lambda: init_progress(spark, store.progress),
        "adopt": lambda: adopt_csv_tree(spark, Store.under(args.adopt_from, raw_format="csv"), store),
        "index": lambda: index_titles(spark, store),
        "extract": lambda: extract_page(spark, store, pages, site, version=args.version),
        "count": lambda: count_districts(spark, store, places, args.country, whole_value=args.whole_value),
        "clean": lambda: clean_page(spark, store, args.allow_whole),
        "batch": lambda: run_batch(
            spark, store, pages, places, site, args.country, version=args.version, allow_whole=args.allow_whole,
            whole_value=args.whole_value),
    }
    print(args.job, jobs[args.job]())


if __name__ == "__main__":
    main()
