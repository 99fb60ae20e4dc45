"""Page-task ledger: states of tasks from the attempts made on them.

The row-by-row state machine is restated as sets: pending rows are generated,
results are folded per task, terminal states are a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_ATTEMPTS = 3
# Return codes that make another attempt useless.
FINAL_CODES = (4, 6, 11, 30)


def expand_tasks(books: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Pending tasks 1..pages of every book, without those that exist.  A book
    of no pages makes none (``empty_books`` lists it)."""
    tasks = books.where("pages > 0").select(
        "book_id", F.explode(F.sequence(F.lit(1), F.col("pages"))).alias("page")
    )
    if existing is not None:
        tasks = tasks.join(existing.select("book_id", "page"), ["book_id", "page"], "left_anti")
    return tasks.select("book_id", "page", F.lit("pending").alias("status"), F.lit(0).alias("attempts"))


def empty_books(books: DataFrame) -> DataFrame:
    return books.where("pages IS NULL OR pages <= 0").select("book_id", F.lit("no_pages").alias("code"))


def recovered(tasks: DataFrame) -> DataFrame:
    """After a restart: what was in process is pending again."""
    open_ = F.col("status") == "processing"
    return tasks.withColumns(
        {"status": F.when(open_, "pending").otherwise(F.col("status")), "started_at": F.when(~open_, F.col("started_at"))}
    )


def reset(tasks: DataFrame, book: Column) -> DataFrame:
    """All tasks of the books for which ``book`` holds begin anew."""
    gone = ("output_path", "error_message", "started_at", "finished_at", "source_hash")
    clear = {c: F.when(~book, F.col(c)) for c in gone if c in tasks.columns}
    return tasks.withColumns(
        clear | {"status": F.when(book, "pending").otherwise(F.col("status")), "attempts": F.when(book, 0).otherwise(F.col("attempts"))}
    )


def reset_skipped(skipped: DataFrame, books: DataFrame, by: str = "book_id") -> DataFrame:
    """The table of skipped tasks without those of the books that begin anew."""
    return skipped.join(books.select(by).distinct(), by, "left_anti")


def legacy_status(c: Column) -> Column:
    return F.when(c.isin("failed", "processing"), "pending").otherwise(c)


def import_legacy(tasks: DataFrame, legacy: DataFrame, books: DataFrame) -> DataFrame:
    """Tasks with those of an older table (book_name, page, status,
    error_message, timestamp) that are not there yet, found by the book's
    title; what was failed or in process is pending again, without attempts."""
    status = legacy_status(F.col("status"))
    over = status.isin("done", "skipped")
    moved = legacy.join(books.select("book_id", F.col("title").alias("book_name")), "book_name").select(
        "book_id",
        "page",
        status.alias("status"),
        F.lit(0).alias("attempts"),
        F.when(over, F.col("error_message")).alias("error_message"),
        F.when(over, F.col("timestamp")).alias("finished_at"),
    )
    return tasks.unionByName(moved.join(tasks.select("book_id", "page"), ["book_id", "page"], "left_anti"), allowMissingColumns=True)


def succeeded(ok: Column, size: Column | None = None) -> Column:
    """A result counts if it is no failure and its output is not empty."""
    out = F.coalesce(ok, F.lit(False))
    return out if size is None else out & (F.coalesce(size, F.lit(0)) > 0)


def fold_attempts(
    events: DataFrame, keys: list[str], order: list[str], max_attempts: int = MAX_ATTEMPTS, keep: tuple[str, ...] = ()
) -> DataFrame:
    """What the attempts on each task come to (columns ok, rc, message, kept).

    Attempts count in order up to the first that ends the task: success, a
    final code, or the last allowed failure.  Result: keys, ended_ok,
    ended_final, failures (the counted ones in order, at most
    ``max_attempts``), last (the ending or last counted attempt).

    Of a task's failures only the first ``max_attempts`` matter, of its endings
    only the first; both are cut down before the shuffle, so a task with very
    many attempts is no hot key.
    """
    at = F.struct(*order)
    row = F.struct(at.alias("place_"), F.col("rc").alias("rc"), F.substring("message", 1, 500).alias("message"), *[F.col(c).alias(f"kept_{c}") for c in keep])
    final = F.col("rc").isin(*FINAL_CODES)
    w = Window.partitionBy(*keys).orderBy(*order)
    failures = (
        events.where(~F.col("ok"))
        .withColumn("n_", F.row_number().over(w))
        .where(F.col("n_") <= max_attempts)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(row)).alias("failures"))
    )
    endings = (
        events.where(F.col("ok") | final)
        .groupBy(*keys)
        .agg(F.min_by(F.struct(row.alias("row"), F.col("ok").alias("ok")), at).alias("ending"))
    )
    both = failures.join(endings, keys, "full").withColumn("failures", F.coalesce("failures", F.array().cast(failures.schema["failures"].dataType)))
    exhausted = F.get("failures", F.lit(max_attempts - 1))["place_"]
    end = F.least(F.col("ending.row.place_"), exhausted)
    counted = F.when(end.isNull(), F.col("failures")).otherwise(F.filter("failures", lambda f: f["place_"] <= end))
    ended = F.coalesce(F.col("ending.row.place_") == end, F.lit(False))
    return both.select(
        *keys,
        (ended & F.col("ending.ok")).alias("ended_ok"),
        (ended & ~F.col("ending.ok")).alias("ended_final"),
        counted.alias("failures"),
        F.when(ended, F.col("ending.row")).otherwise(F.try_element_at(counted, F.lit(-1))).alias("last"),
    )


def _status(max_attempts: int) -> Column:
    return (
        F.when(F.col("ended_ok"), "done")
        .when(F.col("ended_final") | (F.size("failures") >= max_attempts), "skipped")
        .otherwise("pending")
    )


def _attempts() -> Column:
    return F.size("failures") + F.col("ended_ok").cast("int")


def final_states(events: DataFrame, keys: list[str], order: list[str], max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """keys, attempts, status, first_error, last_error of each task."""
    return fold_attempts(events, keys, order, max_attempts).select(
        *keys,
        _attempts().cast("int").alias("attempts"),
        _status(max_attempts).alias("status"),
        F.get("failures", F.lit(0))["message"].alias("first_error"),
        F.try_element_at("failures", F.lit(-1))["message"].alias("last_error"),
    )


def task_rows(
    events: DataFrame, keys: list[str], order: list[str], at: str, max_attempts: int = MAX_ATTEMPTS,
    output: str | None = None, source_hash: str | None = None, backoff: float = 2.0,
) -> DataFrame:
    """The ledger's row of each task after its attempts: keys, status,
    failed_attempts (a success is none), error_message (none when done),
    finished_at, output_path and source_hash (when done), and wait_seconds
    before the next attempt, which doubles with each failure."""
    keep = tuple(c for c in (at, output, source_hash) if c)
    folded = fold_attempts(events, keys, order, max_attempts, keep)
    status = _status(max_attempts)
    when_done = lambda c: F.when(F.col("ended_ok"), F.col(f"last.kept_{c}") if c else F.lit(None).cast("string"))
    return folded.select(
        *keys,
        status.alias("status"),
        F.size("failures").alias("failed_attempts"),
        F.when(~F.col("ended_ok"), F.col("last.message")).alias("error_message"),
        F.col(f"last.kept_{at}").alias("finished_at"),
        when_done(output).alias("output_path"),
        when_done(source_hash).alias("source_hash"),
        F.when(status == "pending", F.lit(float(backoff)) * F.pow(F.lit(2.0), F.size("failures"))).alias("wait_seconds"),
    )


def skipped_rows(events: DataFrame, keys: list[str], order: list[str], at: str, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """The table of skipped tasks: keys, reason, attempts, first_error,
    last_error, skipped_at.

    ``first_error`` is the error that the ledger held when the task was given
    up: after a final code that of the failure before, if there is one; after
    the last allowed failure that failure's own.
    """
    folded = fold_attempts(events, keys, order, max_attempts, (at,))
    last = F.try_element_at("failures", F.lit(-1))["message"]
    before = F.get("failures", F.size("failures") - 2)["message"]
    spent = F.col("failures").isNotNull() & ~F.col("ended_final")
    return folded.where(_status(max_attempts) == "skipped").select(
        *keys,
        F.lit("ocr_failed").alias("reason"),
        F.size("failures").alias("attempts"),
        F.when(spent, last).otherwise(F.coalesce(before, last)).alias("first_error"),
        last.alias("last_error"),
        F.col(f"last.kept_{at}").alias("skipped_at"),
    )


def incomplete(tasks: DataFrame, books: DataFrame, done: str = "done") -> DataFrame:
    """One row: whether any book has not exactly its pages done; an empty list
    of books is complete."""
    n = tasks.where(F.col("status") == done).groupBy("book_id").agg(F.count("*").alias("n"))
    short = books.join(n, "book_id", "left").agg(F.bool_or(F.coalesce("n", F.lit(0)) != F.coalesce("pages", F.lit(0))).alias("x"))
    return short.select(F.coalesce("x", F.lit(False)).alias("incomplete"))


def status_counts(tasks: DataFrame, *by: str) -> DataFrame:
    return tasks.groupBy(*by, "status").agg(F.count("*").alias("n"))


def completeness(tasks: DataFrame, by: str, done: str = "complete") -> DataFrame:
    """Whether all tasks of a group are done."""
    finished = F.count_if(F.col("status") == done)
    return tasks.groupBy(by).agg(
        F.count("*").alias("n"), finished.alias("done"), (finished == F.count("*")).alias("is_complete")
    )


def next_tasks(tasks: DataFrame, by: str, order: str, open_status: str = "pending") -> DataFrame:
    """The first open task of each group."""
    return tasks.where(F.col("status") == open_status).groupBy(by).agg(F.min(order).alias(order))


def unchanged(books: DataFrame, done: DataFrame, by: str) -> DataFrame:
    """Books whose source hash is that of their last done task."""
    same = done.where("source_hash IS NOT NULL").select(by, F.upper(F.trim("source_hash")).alias("h")).distinct()
    return books.withColumn("h", F.upper(F.trim("source_hash"))).join(same, [by, "h"], "left_semi").drop("h")


def workers_for_memory(free_mb: Column, most: Column | int) -> Column:
    """Workers that the free memory allows, by bands."""
    most = most if isinstance(most, Column) else F.lit(most)
    return F.when(free_mb < 800, 0).when(free_mb < 1500, 1).when(free_mb < 2500, F.least(F.lit(2), most)).otherwise(most)
