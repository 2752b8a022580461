"""Registry, queue and job state; geometry of screen boxes; gaps and runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.plans import views as v

AS_OF = "2024-01-31 00:00:00"


def registry_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: each status with zero for none, total, what remains."""
    r = v.registry(spark, sf_dir)
    counts = r.agg(*[F.count_if(F.col("status") == s).alias(s) for s in fixed.STATUSES], F.count("*").alias("total"))
    return counts.withColumn("remaining", F.col("pending") + F.col("processing"))


REGISTRY_STATUS = f"""WITH {v.REGISTRY} SELECT {', '.join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in fixed.STATUSES)}, count(*) AS total,
  count(*) FILTER (WHERE status IN ('pending', 'processing')) AS remaining FROM v_registry"""


def registry_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = v.registry(spark, sf_dir)
    done = F.col("status") == "completed"
    return r.groupBy("worker").agg(
        F.count("*").alias("files"), F.floor(F.avg(F.when(done, F.col("duration")))).alias("mean_duration"),
        F.coalesce(F.sum(F.when(done, F.col("duration"))), F.lit(0)).alias("duration"),
        F.floor(100 * F.count_if(done) / F.greatest(F.count("*"), F.lit(1))).alias("percent"),
        F.max("started_at").alias("last_seen"),
    )


REGISTRY_PROGRESS = f"""WITH {v.REGISTRY} SELECT worker, count(*) AS files, floor(avg(duration) FILTER (WHERE status = 'completed'))::BIGINT AS mean_duration,
  coalesce(sum(duration) FILTER (WHERE status = 'completed'), 0)::BIGINT AS duration, floor(100.0 * count(*) FILTER (WHERE status = 'completed') / greatest(count(*), 1))::BIGINT AS percent,
  max(started_at) AS last_seen FROM v_registry GROUP BY worker"""


def registry_claim_next(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The oldest pending file and who may take it."""
    return v.registry(spark, sf_dir).where("status = 'pending'").orderBy("started_at", "file_id").limit(1).select("file_id", "worker", "started_at")


REGISTRY_CLAIM_NEXT = f"WITH {v.REGISTRY} SELECT file_id, worker, started_at FROM v_registry WHERE status = 'pending' ORDER BY started_at, file_id LIMIT 1"


def stalled_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in work for over thirty minutes go back to pending; the age is in whole seconds."""
    as_of = F.lit(AS_OF).cast("timestamp")
    stalled = (F.col("status") == "processing") & (F.col("started_at") < as_of - F.expr("INTERVAL 30 MINUTES"))
    r = v.registry(spark, sf_dir)
    return r.select(
        "file_id", F.when(stalled, "pending").otherwise(F.col("status")).alias("status"), stalled.alias("reset"),
        F.timestamp_diff("SECOND", F.col("started_at"), as_of).alias("age"), F.date_format("started_at", "yyyyMMdd_HHmmss").alias("stamp"),
    )


STALLED_RESET = f"""WITH {v.REGISTRY}, s AS (SELECT *, status = 'processing' AND started_at < TIMESTAMP '{AS_OF}' - INTERVAL 30 MINUTE AS reset FROM v_registry)
SELECT file_id, CASE WHEN reset THEN 'pending' ELSE status END AS status, reset, floor(epoch_us(TIMESTAMP '{AS_OF}') / 1000000 - epoch_us(started_at) / 1000000.0)::BIGINT AS age,
  strftime(started_at, '%Y%m%d_%H%M%S') AS stamp FROM s"""


def registry_register_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files to insert: those whose worker and type are not registered yet, each pair once."""
    r = v.registry(spark, sf_dir)
    old = r.where("started_at < timestamp'2024-01-10'").select("worker", "event_type")
    new = r.where("started_at >= timestamp'2024-01-10'")
    fresh = new.join(old, ["worker", "event_type"], "left_anti")
    return fresh.groupBy("worker", "event_type").agg(F.min(F.struct("started_at", "file_id")).alias("f")).select("worker", "event_type", F.col("f.file_id").alias("file_id"))


REGISTRY_REGISTER_NEW = f"""WITH {v.REGISTRY} SELECT worker, event_type, first(file_id ORDER BY started_at, file_id) AS file_id FROM v_registry n
WHERE started_at >= TIMESTAMP '2024-01-10' AND NOT EXISTS (SELECT 1 FROM v_registry o WHERE o.started_at < TIMESTAMP '2024-01-10' AND o.worker = n.worker AND o.event_type = n.event_type)
GROUP BY worker, event_type"""


def worker_queue_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open files by priority, then age; the first hundred, and each worker's oldest open file."""
    r = v.registry(spark, sf_dir).where(F.col("status").isin("pending", "processing")).withColumn("priority", (F.col("duration") % 3).cast("int"))
    return r.orderBy(F.col("priority").desc(), "started_at", "file_id").limit(100).select("file_id", "priority", "worker")


WORKER_QUEUE_ORDER = f"""WITH {v.REGISTRY} SELECT file_id, (duration % 3)::INT AS priority, worker FROM v_registry WHERE status IN ('pending', 'processing')
ORDER BY priority DESC, started_at, file_id LIMIT 100"""


def job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a job's files and the status that follows; unchanged where no rule holds."""
    j = v.job(spark, sf_dir)
    n = j.groupBy("job_id").agg(*[F.count_if(F.col("status") == s).alias(s) for s in fixed.STATUSES[:4]], F.count("*").alias("files"))
    open_ = F.col("pending") + F.col("processing")
    status = (
        F.when((open_ == 0) & (F.col("completed") >= 1), "completed").when((open_ == 0) & (F.col("completed") == 0), "failed")
        .when(F.col("processing") > 0, "processing").otherwise("unchanged")
    )
    percent = F.when(F.col("files") == 0, 0).otherwise(F.floor(100 * (F.col("completed") + F.col("failed")) / F.col("files")))
    return n.withColumns({"status": status, "percent": percent})


JOB_COUNTERS = f"""WITH {v.JOB}, n AS (SELECT job_id, {', '.join(f"count(*) FILTER (WHERE status = '{s}') AS {s}" for s in fixed.STATUSES[:4])}, count(*) AS files FROM v_job GROUP BY job_id)
SELECT *, CASE WHEN pending + processing = 0 AND completed >= 1 THEN 'completed' WHEN pending + processing = 0 THEN 'failed' WHEN processing > 0 THEN 'processing' ELSE 'unchanged' END AS status,
  floor(100.0 * (completed + failed) / files)::BIGINT AS percent FROM n"""


def heartbeat_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest state of each worker: the last write wins."""
    r = v.registry(spark, sf_dir)
    return r.groupBy("worker").agg(F.max(F.struct("started_at", "file_id", "status")).alias("r")).select(
        "worker", F.col("r.started_at").alias("last_seen"), F.col("r.status").alias("status"), F.col("r.file_id").alias("file_id")
    )


HEARTBEAT_LATEST = f"""WITH {v.REGISTRY} SELECT worker, started_at AS last_seen, status, file_id FROM v_registry
QUALIFY row_number() OVER (PARTITION BY worker ORDER BY started_at DESC, file_id DESC) = 1"""


def user_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every user's cached products, with how often each was opened and when last."""
    cache = v.registry(spark, sf_dir).withColumn("signature", F.substring(F.md5("event_type"), 1, 16))
    cached = cache.groupBy("worker", "signature").agg(F.count("*").alias("accesses"), F.max("started_at").alias("last"))
    # one row for each event type
    known = cache.select("signature", "event_type").distinct()
    return cached.join(known, "signature").select("worker", "event_type", "accesses", "last")


USER_PRODUCTS = f"""WITH {v.REGISTRY} SELECT worker, event_type, count(*) AS accesses, max(started_at) AS last FROM v_registry GROUP BY ALL"""


def session_api_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest status of each service for a session, one column a service."""
    r = v.registry(spark, sf_dir)
    latest = F.max_by("duration", F.struct("started_at", "file_id"))
    return r.groupBy(F.col("worker").alias("session")).pivot("event_type", ["signup", "view", "click", "purchase", "error"]).agg(latest)


SESSION_API_PIVOT = f"""WITH {v.REGISTRY} SELECT worker AS session, {', '.join(f"last(duration ORDER BY started_at, file_id) FILTER (WHERE event_type = '{e}') AS {e}" for e in ('signup', 'view', 'click', 'purchase', 'error'))}
FROM v_registry GROUP BY worker"""


def circuit_breaker(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failures in a row of each worker before each attempt; open from three on, closed again 300 s after the last failure."""
    r = v.registry(spark, sf_dir).withColumn("failed", F.col("status") == "failed")
    order = Window.partitionBy("worker").orderBy("started_at", "file_id")
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumn("run", F.coalesce(F.count_if(~F.col("failed")).over(upto), F.lit(0)))
    within = Window.partitionBy("worker", "run").orderBy("started_at", "file_id").rowsBetween(Window.unboundedPreceding, -1)
    r = r.withColumns({"failures": F.coalesce(F.count_if("failed").over(within), F.lit(0)), "last_failure": F.max(F.when(F.col("failed"), F.col("started_at"))).over(upto)})
    age = F.timestamp_diff("SECOND", F.col("last_failure"), F.col("started_at"))
    return r.withColumn("open", (F.col("failures") >= 3) & (age < 300)).groupBy("worker").agg(
        F.count("*").alias("attempts"), F.max("failures").alias("longest_run"), F.count_if("open").alias("rejected")
    )


CIRCUIT_BREAKER = f"""WITH {v.REGISTRY}, a AS (SELECT *, status = 'failed' AS failed,
  count(*) FILTER (WHERE status <> 'failed') OVER w AS run, max(started_at) FILTER (WHERE status = 'failed') OVER w AS last_failure
  FROM v_registry WINDOW w AS (PARTITION BY worker ORDER BY started_at, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
b AS (SELECT *, count(*) FILTER (WHERE failed) OVER (PARTITION BY worker, run ORDER BY started_at, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS failures FROM a)
SELECT worker, count(*) AS attempts, max(failures) AS longest_run, count(*) FILTER (WHERE failures >= 3 AND epoch_us(started_at) - epoch_us(last_failure) < 300000000) AS rejected FROM b GROUP BY worker"""


def review_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = v.read(spark, sf_dir, "labels").where("doc_id is not null")
    documents = v.read(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(labels, "doc_id").groupBy("lang").agg(
        F.count("*").alias("labelled"), F.count_if(F.col("quality") == 0).alias("review"), F.count_if(F.col("toxic") == 1).alias("toxic"),
        F.floor(100 * F.count_if(F.col("quality") == 0) / F.greatest(F.count("*"), F.lit(1))).alias("percent"), F.floor(F.avg("n_chars")).alias("mean_chars"),
    )


REVIEW_RATE = """SELECT lang, count(*) AS labelled, count(*) FILTER (WHERE quality = 0) AS review, count(*) FILTER (WHERE toxic = 1) AS toxic,
  floor(100.0 * count(*) FILTER (WHERE quality = 0) / greatest(count(*), 1))::BIGINT AS percent, floor(avg(n_chars))::BIGINT AS mean_chars FROM documents JOIN labels USING (doc_id) GROUP BY lang"""


def _overlap(a: str, b: str, least, greatest):
    w = greatest(least(F.col(f"{a}.x") + F.col(f"{a}.w"), F.col(f"{b}.x") + F.col(f"{b}.w")) - greatest(F.col(f"{a}.x"), F.col(f"{b}.x")), F.lit(0))
    h = greatest(least(F.col(f"{a}.y") + F.col(f"{a}.h"), F.col(f"{b}.y") + F.col(f"{b}.h")) - greatest(F.col(f"{a}.y"), F.col(f"{b}.y")), F.lit(0))
    return w * h


def box_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a screen's boxes that overlap, with intersection over union in percent.

    Each line of an order is one box, so a screen has few; the join is by screen.
    """
    boxes = v.box(spark, sf_dir)
    a, b = boxes.alias("a"), boxes.alias("b")
    both = _overlap("a", "b", F.least, F.greatest)
    pairs = a.join(b, (F.col("a.screen") == F.col("b.screen")) & (F.col("a.ord") < F.col("b.ord")))
    union = F.col("a.w") * F.col("a.h") + F.col("b.w") * F.col("b.h") - both
    return pairs.where(both > 0).select(
        F.col("a.screen").alias("screen"), F.col("a.ord").alias("first"), F.col("b.ord").alias("second"), both.alias("common"), F.floor(100 * both / union).alias("iou"),
        (2 * both > F.col("b.w") * F.col("b.h")).alias("half_covered"),
    )


_INTER = "greatest(least(a.x + a.w, b.x + b.w) - greatest(a.x, b.x), 0) * greatest(least(a.y + a.h, b.y + b.h) - greatest(a.y, b.y), 0)"
BOX_OVERLAP = f"""WITH {v.BOX}, p AS (SELECT a.screen, a.ord AS first, b.ord AS second, {_INTER} AS common, a.w * a.h AS sa, b.w * b.h AS sb
  FROM v_box a JOIN v_box b ON a.screen = b.screen AND a.ord < b.ord)
SELECT screen, first, second, common, floor(100.0 * common / (sa + sb - common))::BIGINT AS iou, 2 * common > sb AS half_covered FROM p WHERE common > 0"""


def box_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes clipped to a 500 by 900 canvas, tile and button tests, the four largest of each screen."""
    b = v.box(spark, sf_dir)
    clipped = b.withColumns({"cw": F.least("w", F.greatest(500 - F.col("x"), F.lit(0))), "ch": F.least("h", F.greatest(900 - F.col("y"), F.lit(0)))})
    area = F.col("cw") * F.col("ch")
    place = F.row_number().over(Window.partitionBy("screen").orderBy(area.desc(), "ord", "x", "y"))
    tile = (area > 15000) & (10 * F.col("cw") >= 8 * F.col("ch")) & (100 * F.col("cw") <= 125 * F.col("ch"))
    return clipped.select("screen", "ord", "cw", "ch", tile.alias("tile"), place.alias("rank")).where("rank <= 4")


BOX_FILTERS = f"""WITH {v.BOX}, c AS (SELECT screen, ord, x, y, least(w, greatest(500 - x, 0)) AS cw, least(h, greatest(900 - y, 0)) AS ch FROM v_box)
SELECT screen, ord, cw, ch, cw * ch > 15000 AND 10 * cw >= 8 * ch AND 100 * cw <= 125 * ch AS tile, row_number() OVER (PARTITION BY screen ORDER BY cw * ch DESC, ord, x, y)::INT AS rank
FROM c QUALIFY rank <= 4"""


def row_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest gap between neighbouring boxes of a screen, from top to bottom, and the grid place of the first below it."""
    b = v.box(spark, sf_dir)
    order = Window.partitionBy("screen").orderBy("y", "x", "ord")
    gaps = b.select("screen", "y", F.lag("y").over(order).alias("above"), F.row_number().over(order).alias("place")).where("above is not null")
    best = gaps.groupBy("screen").agg(F.max(F.struct((F.col("y") - F.col("above")).alias("gap"), (-F.col("place")).alias("p"), "y")).alias("g"))
    return best.select("screen", F.col("g.gap").alias("gap"), (-F.col("g.p")).alias("place"), F.col("g.y").alias("row_starts"))


ROW_GAPS = f"""WITH {v.BOX}, g AS (SELECT screen, y, lag(y) OVER w AS above, row_number() OVER w AS place FROM v_box WINDOW w AS (PARTITION BY screen ORDER BY y, x, ord))
SELECT screen, y - above AS gap, place::INT AS place, y AS row_starts FROM g WHERE above IS NOT NULL QUALIFY row_number() OVER (PARTITION BY screen ORDER BY y - above DESC, place) = 1"""


def row_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of a worker's attempts of one outcome, by gaps and islands; the running mean of durations at each run's end."""
    r = v.registry(spark, sf_dir)
    order = Window.partitionBy("worker").orderBy("started_at", "file_id")
    r = r.withColumn("new", (~F.col("status").eqNullSafe(F.lag("status").over(order))).cast("int"))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    r = r.withColumns({"run": F.sum("new").over(upto), "total": F.sum("duration").over(upto), "n": F.count("*").over(upto)})
    return r.groupBy("worker", "run").agg(
        F.first("status").alias("status"), F.count("*").alias("length"), F.floor(F.max_by("total", "n") / F.max("n")).alias("running_mean")
    )


ROW_RUNS = f"""WITH {v.REGISTRY}, l AS (SELECT *, lag(status) OVER w AS prev FROM v_registry WINDOW w AS (PARTITION BY worker ORDER BY started_at, file_id)),
r AS (SELECT *, (sum(CASE WHEN status IS DISTINCT FROM prev THEN 1 ELSE 0 END) OVER w)::BIGINT AS run, (sum(duration) OVER w)::BIGINT AS total, count(*) OVER w AS n
  FROM l WINDOW w AS (PARTITION BY worker ORDER BY started_at, file_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT worker, run, first(status) AS status, count(*) AS length, floor(last(total ORDER BY n) / max(n))::BIGINT AS running_mean FROM r GROUP BY worker, run"""


def section_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles in the screen section whose range of rows holds them.

    Sections have equal heights, so the range join is an equi join on the section's number.
    """
    b = v.box(spark, sf_dir).withColumn("section", F.floor(F.col("y") / 100))
    return b.groupBy("screen", "section").agg(F.count("*").alias("tiles"), F.min("y").alias("top"), F.max(F.col("y") + F.col("h")).alias("bottom"))


SECTION_TILES = f"""WITH {v.BOX}, s AS (SELECT k AS section, k * 100 AS a, (k + 1) * 100 AS b FROM range(0, 9) AS t(k))
SELECT screen, section, count(*) AS tiles, min(y) AS top, max(y + h) AS bottom FROM v_box JOIN s ON y >= a AND y < b GROUP BY ALL"""

QUERIES = {
    "registry_status": (registry_status, REGISTRY_STATUS),
    "registry_progress": (registry_progress, REGISTRY_PROGRESS),
    "registry_claim_next": (registry_claim_next, REGISTRY_CLAIM_NEXT),
    "stalled_reset": (stalled_reset, STALLED_RESET),
    "registry_register_new": (registry_register_new, REGISTRY_REGISTER_NEW),
    "worker_queue_order": (worker_queue_order, WORKER_QUEUE_ORDER),
    "job_counters": (job_counters, JOB_COUNTERS),
    "heartbeat_latest": (heartbeat_latest, HEARTBEAT_LATEST),
    "user_products": (user_products, USER_PRODUCTS),
    "session_api_pivot": (session_api_pivot, SESSION_API_PIVOT),
    "circuit_breaker": (circuit_breaker, CIRCUIT_BREAKER),
    "review_rate": (review_rate, REVIEW_RATE),
    "box_overlap": (box_overlap, BOX_OVERLAP),
    "box_filters": (box_filters, BOX_FILTERS),
    "row_gaps": (row_gaps, ROW_GAPS),
    "row_runs": (row_runs, ROW_RUNS),
    "section_tiles": (section_tiles, SECTION_TILES),
}
