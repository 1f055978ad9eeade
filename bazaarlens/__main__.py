"""Jobs for spark-submit or ``python -m bazaarlens``.

popular BASE [N]           rank the archived searches of BASE and store the popular list
recommend BASE             recommend for every archived search of BASE and store the messages
search LINES NAME [--log BASE] [--topics LOG]
                           products of a filtered-line file whose name contains NAME; the search
                           joins the archive of BASE, or goes to the request topic of LOG
stream-recommend LOG BASE  a recommendation on LOG for every request on it, continuously; --once works
                           off what is there. The checkpoint is below BASE
stream-archive LOG BASE    the requests of LOG into the archive of BASE; --once as above
next LOG GROUP             the next recommendation of LOG that GROUP has not taken
import-list FILE TABLE     store an allow-list document as a table
list | clear TABLE         show or empty an allow-list table
add | remove TABLE ID..    edit an allow-list table
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .operators import catalog, popularity, recommend, search
from .session import build_session
from .sinks.files import write_allow_list, write_batch
from .sinks.topics import as_messages, write_log
from .sources import files
from .sources.topics import BATCH_SIZE, committed, stream_log
from .streaming import jobs
from .streaming.jobs import log_request, refresh_once


def _ids(spark: SparkSession, values: list[str]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(values, 1)), schemas.ALLOW_LIST)


def _continuous(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Run a job over the request topic of a log; shows how far it got."""
    messages = stream_log(spark, args.topics, args.job, [jobs.REQUESTS], args.per_batch)
    checkpoint = f"{args.base}/checkpoints/{args.job}"
    if args.job == "stream-archive":
        query = jobs.archive_requests(messages, f"{args.base}/requests", checkpoint, every=jobs.GATHERED)
    else:
        bad = f"{args.base}/quarantine"

        def write(found: DataFrame, batch_id: int) -> None:
            write_log(found.withColumn("topic", F.lit(jobs.RECOMMENDATIONS)), args.topics, args.job, batch_id)

        query = jobs.recommend_requests(messages, args.base, "", bad, checkpoint, write=write, every=jobs.GATHERED)
    if args.once:
        jobs.drain(query)
    else:
        query.awaitTermination()
    return committed(spark, args.topics, args.job).orderBy("topic", "partition")


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Do what was asked and return what there is to show."""
    if args.job in ("stream-recommend", "stream-archive"):
        return _continuous(spark, args)
    if args.job == "next":
        return jobs.next_recommendation(spark, args.topics, args.group).select("topic", "partition", "offset", "value")
    if args.job == "popular":
        return refresh_once(spark, args.base, args.n)
    if args.job == "recommend":
        found = recommend.recommend_now(files.read_requests(spark, args.base), files.read_popular(spark, args.base))
        write_batch(as_messages(found, "recommendations"), f"{args.base}/messages", 0)
        return spark.read.parquet(f"{args.base}/messages/batch_id=0")
    if args.job == "search":
        if args.log:
            log_request(spark, args.name, args.log)
        if args.topics:
            jobs.publish_request(spark, args.name, args.topics)
        return search.display(search.search(files.read_filtered_products(spark, args.lines), args.name))
    if args.job == "import-list":
        write_allow_list(files.read_allow_list(spark, args.file), args.table)
    listed = files.read_allow_table(spark, args.table)
    if args.job == "add":
        write_allow_list(catalog.add_ids(listed, _ids(spark, args.ids)), args.table)
    elif args.job == "remove":
        write_allow_list(catalog.remove_ids(listed, _ids(spark, args.ids).select("product_id"), check=True), args.table)
    elif args.job == "clear":
        write_allow_list(catalog.clear_ids(listed), args.table)
    return catalog.numbered(files.read_allow_table(spark, args.table)).orderBy("line")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="bazaarlens", description=__doc__, formatter_class=argparse.RawTextHelpFormatter)
    listed = top.add_subparsers(dest="job", required=True)
    popular = listed.add_parser("popular")
    popular.add_argument("base")
    popular.add_argument("n", type=int, nargs="?", default=popularity.TOP_N)
    listed.add_parser("recommend").add_argument("base")
    find = listed.add_parser("search")
    find.add_argument("lines")
    find.add_argument("name")
    find.add_argument("--log", metavar="BASE")
    find.add_argument("--topics", metavar="LOG")
    for name in ("stream-recommend", "stream-archive"):
        stream = listed.add_parser(name)
        stream.add_argument("topics", metavar="LOG")
        stream.add_argument("base")
        stream.add_argument("--once", action="store_true")
        stream.add_argument("--per-batch", type=int, default=BATCH_SIZE)
    following = listed.add_parser("next")
    following.add_argument("topics", metavar="LOG")
    following.add_argument("group")
    load = listed.add_parser("import-list")
    load.add_argument("file")
    load.add_argument("table")
    for name in ("list", "clear", "add", "remove"):
        edit = listed.add_parser(name)
        edit.add_argument("table")
        if name in ("add", "remove"):
            edit.add_argument("ids", nargs="+")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    shown = run(build_session(), args)
    print(*shown.columns, sep="\t")
    for row in shown.toLocalIterator():  # every row, a partition at a time
        print(*row, sep="\t")


if __name__ == "__main__":
    main()
