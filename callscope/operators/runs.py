"""Sessions against dispatched workflow runs, and the checks made on them."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from callscope.functions.clients import client_family
from callscope.operators.ordered import TASK_ROWS, dealt, keep_first

SESSION = ["server_id", "session_key"]
BEGINNINGS = (1, 2, 4, 8, 16, 32, 64)
MOST_LETTERS = 64  # A place of a run id that holds more different characters may hold any.
#: Session keys that one task holds; long keys compress so well that Spark would put very many in a task.
TASK_BYTES = 128 << 20
ANY_LETTER = r"[^\x{dc00}-\x{dfff}]"  # Never the second half of a character beyond the basic plane.


def label_runs(runs: DataFrame, families: tuple[str, ...] = ("claude_code", "codex")) -> DataFrame:
    """Add the expected `family` of each run and its dispatch's `models`.

    The first model seen in a dispatch stands for the first family, the second for the
    second; a family named in `harness` wins. `labelled` is false for dispatches that
    do not have exactly as many models as families.
    """
    models = runs.groupBy("dispatch_id", "model_id").agg(F.min("pos").alias("first_pos"))
    by_dispatch = Window.partitionBy("dispatch_id").orderBy("first_pos", "model_id")
    ranked = models.withColumn("model_rank", F.dense_rank().over(by_dispatch))
    counted = models.groupBy("dispatch_id").agg(F.count(F.lit(1)).alias("models"))
    names = F.array(*[F.lit(f) for f in families])
    known = ranked.join(counted, "dispatch_id").withColumn("labelled", F.col("models") == len(families))
    family = F.when(F.col("labelled"), F.try_element_at(names, F.col("model_rank")))
    known = known.withColumn("__family", family).drop("first_pos", "model_rank")
    return runs.join(known, ["dispatch_id", "model_id"]).withColumn(
        "family", F.coalesce(F.nullif("harness", F.lit("")), "__family")
    ).drop("__family")


def id_beginnings(runs: DataFrame) -> list[tuple[str, list[int]]]:
    """Pattern and lengths of the run ids whose first 1, 2, 4, .. or 64 characters are looked for.

    An id is looked for by the longest of these beginnings that it has. The pattern holds, place by
    place, the characters that beginnings of this size have there, so it fits wherever an id begins
    and, with ids of a fixed make-up such as UUIDs, hardly anywhere else. At most seven rows with 64
    places of `MOST_LETTERS` characters and one number per length come to the driver, however many ids there are.
    """
    size = F.greatest(*[F.when(F.length("run_id") >= n, n) for n in (0, *BEGINNINGS)]).alias("size")
    ids = runs.filter(F.length("run_id") > 0).select("run_id", size)
    letters = ids.select("size", F.posexplode(F.split(F.expr("left(run_id, size)"), ""))).distinct()
    places = letters.groupBy("size", "pos").agg(
        F.when(F.count(F.lit(1)) <= MOST_LETTERS, F.collect_set("col")).alias("letters")
    )
    lengths = ids.select("size", F.length("run_id").alias("length")).distinct()
    held = lengths.groupBy("size").agg(F.collect_set("length").alias("lengths"))
    rows = places.groupBy("size").agg(F.sort_array(F.collect_list(F.struct("pos", "letters"))).alias("places")).join(held, "size").collect()
    return [("".join(_one_of(p.letters) for p in r.places), sorted(r.lengths)) for r in sorted(rows)]


def _one_of(letters: list[str] | None) -> str:
    if letters is None:
        return ANY_LETTER
    return "[" + "".join(f"\\x{{{ord(c):x}}}" for c in sorted(letters)) + "]"


def key_rows(sessions: DataFrame) -> int:
    """How many rows the session keys weigh: as many as ask for a task for every `TASK_BYTES` of them."""
    size = sessions.agg(F.sum(F.octet_length("session_key"))).first()[0] or 0
    return size * TASK_ROWS // TASK_BYTES


def id_places(sessions: DataFrame, runs: DataFrame, weight: int | None = None) -> DataFrame:
    """Session, and each part of its key that begins like a run id and is as long as one (`run_id`)."""
    keys = dealt(sessions.select(*SESSION), SESSION, key_rows(sessions) if weight is None else weight).distinct()
    parts = [F.array().cast("array<string>")]
    for pattern, lengths in id_beginnings(runs):
        # Looking ahead finds beginnings that overlap, too.
        more = f"{ANY_LETTER}{{0,{lengths[-1]}}}"
        tails = F.array_distinct(F.regexp_extract_all("session_key", F.lit(f"(?=({pattern}{more}))"), F.lit(1)))
        sizes = F.array(*[F.lit(n) for n in lengths])
        parts.append(F.flatten(F.transform(tails, lambda tail: F.transform(  # noqa: B023
            F.filter(sizes, lambda n: n <= F.length(tail)), lambda n: F.substring(tail, F.lit(1), n)))))
    return keys.select(*SESSION, F.explode(F.array_distinct(F.concat(*parts))).alias("run_id"))


def runs_in_keys(sessions: DataFrame, runs: DataFrame) -> DataFrame:
    """Pairs of sessions and runs whose id is contained in the session key.

    Parts of a key that begin like a run id meet the run ids in an equi join, which verifies
    them whole: no pair is tested, and no part of a key travels that cannot be an id. Keys and
    ids of NULL or of no characters pair with nothing.
    """
    ids = runs.select("run_id").filter(F.length("run_id") > 0).distinct()
    weight = key_rows(sessions)
    return dealt(id_places(sessions, runs, weight), ["run_id"], weight).join(ids, "run_id").select(*SESSION, "run_id")


def session_run_ids(sessions: DataFrame, calls: DataFrame, runs: DataFrame) -> DataFrame:
    """Distinct run ids of each session, from its key and from its trace."""
    stamped = calls.filter(F.coalesce("workflow_run_id", F.lit("")) != "").select(
        *SESSION, F.col("workflow_run_id").alias("run_id")
    )
    return runs_in_keys(sessions, runs).unionByName(stamped).distinct()


def correlate_runs(sessions: DataFrame, calls: DataFrame, runs: DataFrame) -> DataFrame:
    """Add `run_ids`, `run_id` and `status` to each session.

    Exactly one run id makes a session `correlated` (or `undispatched` if no run has
    it); none is `missing`, several are `ambiguous`.
    """
    found = session_run_ids(sessions, calls, runs).groupBy(*SESSION).agg(
        F.count(F.lit(1)).alias("run_ids"), F.min("run_id").alias("__one")
    )
    # Looked up before sessions without any run id come in, which would share a NULL key.
    dispatched = runs.select(F.col("run_id").alias("__known")).distinct()
    found = found.join(dispatched, F.col("__one") == F.col("__known"), "left")
    out = sessions.join(found, SESSION, "left").withColumn("run_id", F.when(F.col("run_ids") == 1, F.col("__one")))
    status = (
        F.when(F.coalesce("run_ids", F.lit(0)) == 0, "missing")
        .when(F.col("run_ids") > 1, "ambiguous")
        .when(F.col("__known").isNull(), "undispatched")
        .otherwise("correlated")
    )
    return out.withColumns({"status": status, "run_ids": F.coalesce("run_ids", F.lit(0))}).drop(
        "__one", "__known"
    )


def select_expected(
    correlated: DataFrame, labelled: DataFrame, aliases: dict[str, str] | None = None
) -> DataFrame:
    """One row per run: how many sessions of the expected client family it has, and
    which one if it is exactly one. Other sessions of a run do no harm."""
    sessions = correlated.filter(F.col("run_id").isNotNull()).select(
        "run_id", client_family("client_name", aliases).alias("family"), "session_key"
    )
    wanted = sessions.groupBy("run_id", "family").agg(
        F.count(F.lit(1)).alias("candidates"), F.min("session_key").alias("__key")
    )
    out = labelled.join(wanted, ["run_id", "family"], "left")
    return out.withColumns({
        "candidates": F.coalesce("candidates", F.lit(0)),
        "session_key": F.when(F.col("candidates") == 1, F.col("__key")),
        "selected": F.coalesce(F.col("candidates") == 1, F.lit(False)),
    }).drop("__key")


def run_balance(runs: DataFrame, per_model: int = 2) -> DataFrame:
    """Runs per model of each dispatch; `balanced` when it is the expected number."""
    return runs.groupBy("dispatch_id", "model_id").agg(
        F.count(F.lit(1)).alias("runs"), F.countDistinct("run_id").alias("run_ids")
    ).withColumn("balanced", (F.col("runs") == per_model) & (F.col("run_ids") == F.col("runs")))


def poll_changes(polls: DataFrame) -> DataFrame:
    """One row per poll of a watch: sessions seen, and whether anything changed.

    A poll equals the one before it when both list the same sessions with the same
    event and error counts. Compared row by row, so no list is ever put together.
    """
    row = ["session_id", "event_count", "error_count"]
    times = polls.groupBy("watch_id", "polled_at").agg(F.count("session_id").alias("sessions"))
    in_time = Window.partitionBy("watch_id").orderBy("polled_at")
    times = times.withColumns({
        "before_at": F.lag("polled_at").over(in_time),
        "before": F.coalesce(F.lag("sessions").over(in_time), F.lit(0)),
    })
    now = polls.filter(F.col("session_id").isNotNull())
    earlier = now.withColumnRenamed("polled_at", "before_at")
    same = (
        now.join(times.select("watch_id", "polled_at", "before_at"), ["watch_id", "polled_at"])
        .join(earlier, ["watch_id", "before_at", *row], "left_semi")
        .groupBy("watch_id", "polled_at").agg(F.count(F.lit(1)).alias("same"))
    )
    merged = times.join(same, ["watch_id", "polled_at"], "left")
    same_set = (F.col("sessions") == F.col("before")) & (F.coalesce("same", F.lit(0)) == F.col("sessions"))
    return merged.select("watch_id", "polled_at", "sessions", (~same_set).alias("changed"))


def settled_at(polls: DataFrame, quiet_seconds: int = 30, min_sessions: int = 4) -> DataFrame:
    """When each watch settled: enough sessions, none changed for `quiet_seconds`."""
    so_far = (
        Window.partitionBy("watch_id").orderBy("polled_at")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    since = F.last(F.when(F.col("changed"), F.col("polled_at")), ignorenulls=True).over(so_far)
    quiet = F.unix_micros("polled_at") - F.unix_micros("stable_since")
    done = poll_changes(polls).withColumn("stable_since", since).filter(
        (F.col("sessions") >= min_sessions) & (quiet >= quiet_seconds * 1_000_000)
    )
    return keep_first(done, ["watch_id"], ["polled_at"]).select(
        "watch_id", "stable_since", F.col("polled_at").alias("settled_at"), "sessions"
    )


def settled_windows(
    calls: DataFrame, watch: str, ts: str, span: str = "30 seconds", quiet: str = "30 seconds", min_sessions: int = 4
) -> DataFrame:
    """When each watch settled, out of the calls themselves: enough sessions, and no window of
    `span` added a call for `quiet`.

    A watch's set of sessions and their counts is the same in two snapshots exactly when no
    window between them holds a call, so snapshots are never compared: windows that hold calls
    are the islands, and the first long enough gap behind one with `min_sessions` settles.
    The gap behind the last window ends with the last window of all.
    """
    seen = calls.select(F.col(watch).alias("watch_id"), F.window(ts, span)["end"].alias("upto"), "session_key")
    windows = seen.groupBy("watch_id", "upto").agg(F.count(F.lit(1)).alias("calls"))
    last = windows.agg(F.max("upto").alias("end")).first().end
    # Counts by first window, so that a session's calls never meet in a task.
    firsts = seen.groupBy("watch_id", "session_key").agg(F.min("upto").alias("upto")).groupBy("watch_id", "upto").agg(F.count(F.lit(1)).alias("fresh"))
    fresh = windows.join(firsts, ["watch_id", "upto"], "left").withColumn("new_sessions", F.coalesce("fresh", F.lit(0)))
    in_time = Window.partitionBy("watch_id").orderBy("upto")
    gaps = fresh.withColumns({
        "sessions": F.sum("new_sessions").over(in_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "next_upto": F.lead("upto").over(in_time),
    })
    settled = F.col("upto") + F.expr(f"interval {quiet}")
    # A call in the next window may lie anywhere in it: the gap ends where that window begins.
    gap_ends = F.coalesce(F.col("next_upto") - F.expr(f"interval {span}"), F.lit(last))
    done = gaps.filter((F.col("sessions") >= min_sessions) & (settled <= gap_ends))
    return keep_first(done, ["watch_id"], ["upto"]).select(
        "watch_id", F.col("upto").alias("stable_since"), settled.alias("settled_at"), F.col("sessions")
    )
