"""Scheduled runs, single backfills and reports from the command line.

    spark-submit … -m activation_mart daily-add --sources DIR --master DIR \\
        --start 12/26/2012 --end 12/27/2012
    spark-submit … -m activation_mart report failures --table customer=ops.customer … \\
        --master DIR --bank 2 --out DIR
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import config
from .functions import RunWindow
from .operators import repeated_rows
from .plans import (
    audits,
    backfill,
    backfill_online,
    backfill_quiz,
    backfill_retail,
    build_initial,
    checks,
    run_add,
    run_update,
    tag_internal,
)
from .session import RUNTIME_SETTINGS, named_folder, run_scope
from .sources import MasterStore, Sources

Options = argparse.Namespace


def _config(options: Options) -> config.MartConfig:
    return config.MartConfig(
        test_accounts=config.TestAccountRules(
            secret_words=tuple(options.secret_word),
            house_addresses=tuple(options.house_address),
            house_emails=tuple(options.house_email),
        )
    )


def _window(options: Options) -> RunWindow:
    if not (options.start and options.end):
        raise SystemExit(f"{options.job} needs --start and --end")
    return RunWindow.parse(options.start, options.end)


def _initial(src: Sources, _: MasterStore, options: Options) -> DataFrame:
    blocks = RunWindow.parse(options.start, options.block_end or options.end)
    online = RunWindow.parse(options.online_start or options.start, options.online_end or options.end)
    first = build_initial(src, _window(options), blocks, _config(options))
    return backfill(first, src, online)


#: Jobs that write the next version of the master.
JOBS: dict[str, Callable[[Sources, MasterStore, Options], DataFrame]] = {
    "initial": _initial,
    "daily-add": lambda src, store, o: run_add(src, store.read(), _window(o), _config(o)),
    "daily-update": lambda src, store, o: run_update(src, store.read(), _window(o), _config(o)),
    "backfill-online": lambda src, store, o: backfill_online(store.read(), src, _window(o)),
    "backfill-retail": lambda src, store, o: backfill_retail(store.read(), src),
    "backfill-quiz": lambda src, store, o: backfill_quiz(store.read(), src),
    "tag-internal": lambda src, store, o: tag_internal(store.read(), src),
    "refresh-bank": lambda src, store, o: checks.refresh_bank(store.read(), src),
}


def _online(master: DataFrame, options: Options) -> DataFrame:
    return audits.online_accounts(master, _window(options) if options.start else None)


def _failures(master: DataFrame, src: Sources, options: Options) -> DataFrame:
    if options.bank is None:
        raise SystemExit("report failures needs --bank")
    return audits.failure_report(_online(master, options), src, options.bank)


#: Reports on the master in force.
REPORTS: dict[str, Callable[[DataFrame, Sources, Options], DataFrame]] = {
    "failures": _failures,
    "failed-then-approved": lambda m, src, o: audits.failed_then_approved(_online(m, o), src),
    "unresolved": lambda m, src, o: audits.unresolved(_online(m, o), src),
    "steps": lambda m, src, o: audits.step_distribution(m),
    "exceptions": lambda m, src, o: audits.exceptions(m),
    "duplicates": lambda m, src, o: audits.duplicate_audit(m, src),
    "duplicate-rows": lambda m, src, o: repeated_rows(m, "AccountKey"),
    "duplicate-cards": lambda m, src, o: audits.repeated_cards(m, src, _config(o)),
    "drift": lambda m, src, o: audits.drift_report(m, src, _window(o), _config(o), o.null_safe),
    "bank-changes": lambda m, src, o: checks.bank_changes(m, src),
}


def arguments(argv=None) -> Options:
    parser = argparse.ArgumentParser(prog="activation_mart")
    parser.add_argument("job", choices=[*JOBS, "report"])
    parser.add_argument("report", nargs="?", choices=list(REPORTS), help="which report")
    parser.add_argument("--sources", help="folder with one parquet table per source")
    parser.add_argument(
        "--table", action="append", default=[], metavar="NAME=TABLE",
        help="catalog table of a source, of any database; goes before a table of the folder",
    )
    parser.add_argument("--master", required=True, help="folder of the master's snapshots")
    parser.add_argument("--start", help="first day, month/day/year")
    parser.add_argument("--end", help="day after the last, month/day/year")
    parser.add_argument("--block-end", help="initial: end of the block window, if later")
    parser.add_argument("--online-start", help="initial: start of the online backfill, if later")
    parser.add_argument("--online-end", help="initial: end of the online backfill, if earlier")
    parser.add_argument("--buckets", type=int, help="keep the master bucketed by account")
    parser.add_argument("--secret-word", action="append", default=[], help="LIKE pattern of test accounts")
    parser.add_argument("--house-address", action="append", default=[], help="LIKE pattern")
    parser.add_argument("--house-email", action="append", default=[], help="LIKE pattern")
    parser.add_argument("--bank", type=int, help="report failures: key of the bank")
    parser.add_argument("--null-safe", action="store_true", help="report drift: NULLs differ from values")
    parser.add_argument("--out", help="report: folder to write, which must not exist")
    parser.add_argument("--format", choices=["parquet", "csv", "json"], default="parquet", help="of a report")
    options = parser.parse_args(argv)
    if not (options.sources or options.table):
        parser.error("give --sources, --table or both")
    if any("=" not in pair for pair in options.table):
        parser.error("--table takes NAME=TABLE")
    unknown = {pair.split("=")[0] for pair in options.table} - set(config.SOURCE_SCHEMAS)
    if unknown:
        parser.error(f"no such source: {', '.join(sorted(unknown))}")
    if options.job == "initial" and not (options.start and options.end):
        parser.error("initial needs --start and --end")
    if (options.job == "report") != bool(options.report and options.out):
        parser.error("report takes the name of a report and --out; other jobs take neither")
    return options


def sources(spark: SparkSession, options: Options) -> Sources:
    """Sources from the catalog where a table is named, from the folder otherwise."""
    return Sources.from_places(spark, options.sources, dict(pair.split("=", 1) for pair in options.table))


def run(spark: SparkSession, options: Options) -> int:
    """Run one job and return the number of the master version it wrote, or read for a report.

    What the job settles on the way is removed at its end, also after a failure.
    Where the session names no shared folder it lies under the master's.
    """
    folder = named_folder(spark) or f"{options.master.rstrip('/')}/scratch"
    with run_scope(spark, folder):
        src = sources(spark, options)
        store = MasterStore(spark, options.master, options.buckets)
        if options.job != "report":
            return store.write(JOBS[options.job](src, store, options))
        version = store.version()
        found = REPORTS[options.report](store.read(), src, options)
        found.write.format(options.format).option("header", "true").mode("errorifexists").save(options.out)
        return version


def main() -> None:
    builder = SparkSession.builder.appName("activation-mart")
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    options = arguments()
    version = run(builder.getOrCreate(), options)
    print(f"{options.job}: master version {version}")


if __name__ == "__main__":
    main()
