"""Read file, unit state, request, manifest and processing queries on the test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import manifest as mf
from ..operators import process as pr
from ..operators import reads as rd
from ..operators import requests as rq
from ..operators import state as st
from ..ordering import ORD
from ..sources.archive_xml import distinct_supplementary
from .catalog_queries import SQL_PRINTS, fingerprints
from .registry import Tables, query

# ---------------------------------------------------------------- read files

SQL_FILES = """
files AS (SELECT source AS unit_id, doc_id, CASE WHEN doc_id % 5 = 4 THEN 'orphan' || doc_id || '.fastq.gz'
    WHEN doc_id % 7 = 3 THEN 's' || doc_id || '.txt' ELSE 's' || (doc_id // 2) || '_R' || (doc_id % 2 + 1) || CASE WHEN doc_id % 3 = 0 THEN '.FQ' ELSE '.fastq.gz' END END AS name FROM documents),
reads AS (SELECT unit_id, name, doc_id, regexp_extract(name, '(?is)^(.*?(?:^|[._-])R?)([12])((?:[._-]|$).*)$', 2) AS mate,
    regexp_replace(name, '(?is)^(.*?(?:^|[._-])R?)([12])((?:[._-]|$).*)$', '\\1#\\3') AS pair_key FROM files WHERE lower(name) SIMILAR TO '.*[.](fastq|fq)([.]gz)?'),
pairs AS (SELECT unit_id, pair_key, min(name) FILTER (mate = '1') AS read1, min(name) FILTER (mate = '2') AS read2,
    CAST(count(*) FILTER (mate = '1') AS BIGINT) AS n1, CAST(count(*) FILTER (mate = '2') AS BIGINT) AS n2 FROM reads WHERE mate <> '' GROUP BY unit_id, pair_key)
"""


def read_urls(t: Tables) -> DataFrame:
    """Read file URLs named after documents, grouped by their source."""
    number = F.col("doc_id")
    name = (
        F.when(number % 5 == 4, F.concat(F.lit("orphan"), number, F.lit(".fastq.gz")))
        .when(number % 7 == 3, F.concat(F.lit("s"), number, F.lit(".txt")))
        .otherwise(
            F.concat(
                F.lit("s"),
                F.floor(number / 2),
                F.lit("_R"),
                number % 2 + 1,
                F.when(number % 3 == 0, F.lit(".FQ")).otherwise(F.lit(".fastq.gz")),
            )
        )
    )
    return t.documents.select(
        F.col("source").alias("unit_id"), F.concat(F.lit("https://x.example.org/a%20b/"), name, F.lit("?k=1#f")).alias("url")
    )


@query("classified_reads", f"WITH {SQL_FILES} SELECT unit_id, name, nullif(mate, '') AS mate, CASE WHEN mate <> '' THEN pair_key END AS pair_key FROM reads")
def classified_reads(t: Tables) -> DataFrame:
    """Read files with mate numbers and pair keys."""
    return rd.classify_read_files(read_urls(t)).select("unit_id", "name", "mate", "pair_key")


@query("mate_pairs", f"WITH {SQL_FILES} SELECT * FROM pairs")
def mate_pairs(t: Tables) -> DataFrame:
    """Both mates of every pair."""
    return rd.pair_mates(rd.classify_read_files(read_urls(t)))


@query(
    "pairing_problems",
    f"WITH {SQL_FILES} SELECT unit_id AS key, CASE WHEN n1 > 1 OR n2 > 1 THEN 'duplicate mate for ' ELSE 'incomplete pair ' END || pair_key AS detail FROM pairs WHERE n1 <> 1 OR n2 <> 1",
)
def pairing_problems(t: Tables) -> DataFrame:
    """Duplicate and missing mates."""
    return rd.pairing_violations(rd.pair_mates(rd.classify_read_files(read_urls(t)))).select("key", "detail")


@query(
    "read_layouts",
    f"""WITH {SQL_FILES} SELECT unit_id, CASE WHEN bool_or(mate <> '') AND bool_or(mate = '') THEN 'mixed' WHEN bool_or(mate <> '') THEN 'paired' ELSE 'single' END AS layout,
    CAST(count(*) AS BIGINT) AS n_files FROM reads GROUP BY unit_id""",
)
def read_layouts(t: Tables) -> DataFrame:
    """Layout of every unit."""
    return rd.unit_layouts(rd.classify_read_files(read_urls(t)))


@query(
    "ordered_read_files",
    f"""WITH {SQL_FILES} SELECT unit_id, CASE mate WHEN '1' THEN 'read1' WHEN '2' THEN 'read2' ELSE 'single' END AS role,
    string_agg(name, ',' ORDER BY pair_key, name) AS files FROM reads GROUP BY ALL""",
)
def ordered_read_files(t: Tables) -> DataFrame:
    """Mates in pair order, single files by name."""
    lists = rd.ordered_file_lists(rd.classify_read_files(read_urls(t)))
    return lists.select("unit_id", "role", F.array_join("files", ",").alias("files"))


SQL_RUN_FILES = """RF AS (SELECT DISTINCT 'SAMN' || l_suppkey AS unit_id, 'SRR' || l_orderkey AS run, CAST(1000000000 - l_orderkey AS BIGINT) AS run_pos,
  CASE WHEN l_orderkey % 9 = 0 THEN 'single' ELSE r END AS role FROM lineitem, (VALUES ('read1'), ('read2')) v(r) WHERE NOT (l_suppkey % 10 = 3 AND r = 'read2' AND l_orderkey % 9 <> 0))"""


def run_files(t: Tables) -> DataFrame:
    """Files of the runs of every supplier, one supplier in ten without second mates."""
    lines = t.lineitem.select("l_suppkey", "l_orderkey").distinct()
    roles = F.when(F.col("l_orderkey") % 9 == 0, F.array(F.lit("single"))).when(
        F.col("l_suppkey") % 10 == 3, F.array(F.lit("read1"))
    ).otherwise(F.array(F.lit("read1"), F.lit("read2")))
    return lines.select(
        F.concat(F.lit("SAMN"), "l_suppkey").alias("unit_id"),
        F.concat(F.lit("SRR"), "l_orderkey").alias("run"),
        (F.lit(1000000000) - F.col("l_orderkey")).alias("run_pos"),
        F.explode(roles).alias("role"),
    ).withColumn("path", F.concat_ws("/", F.lit("/runs"), "run", "role"))


@query(
    "run_layouts",
    f"WITH {SQL_RUN_FILES} SELECT unit_id, run, string_agg(role, ',' ORDER BY role) AS roles FROM RF GROUP BY unit_id, run",
)
def run_layouts(t: Tables) -> DataFrame:
    """Roles present per run."""
    return rd.run_layouts(run_files(t)).select("unit_id", "run", F.array_join("roles", ",").alias("roles"))


@query(
    "run_based_layouts",
    f"""WITH {SQL_RUN_FILES}, G AS (SELECT unit_id, bool_or(role = 'read1') AS a, bool_or(role = 'read2') AS b, bool_or(role = 'single') AS s FROM RF GROUP BY unit_id)
    SELECT unit_id, CASE WHEN a AND b AND s THEN 'mixed' WHEN a AND b THEN 'paired' WHEN s THEN 'single' END AS layout,
    CASE WHEN a <> b THEN 'one mate is missing' WHEN NOT (a AND b) AND NOT s THEN 'no usable read files' END AS reason FROM G""",
)
def run_based_layouts(t: Tables) -> DataFrame:
    """Layout of every unit from the files of its runs."""
    return rd.unit_layouts_from_runs(run_files(t))


@query(
    "merge_order",
    f"WITH {SQL_RUN_FILES} SELECT unit_id, role, md5(string_agg('/runs/' || run || '/' || role, ',' ORDER BY run_pos)) AS paths FROM RF GROUP BY unit_id, role",
)
def merge_order(t: Tables) -> DataFrame:
    """Paths to concatenate in run order."""
    return rd.merge_order(run_files(t)).select("unit_id", "role", F.md5(F.array_join("paths", ",")).alias("paths"))


@query(
    "layout_problems",
    """WITH L AS (SELECT o_orderkey, CAST(o_orderkey % 3 AS INTEGER) AS kind, CAST(o_orderkey % 4 AS INTEGER) AS n1, CAST(o_custkey % 3 AS INTEGER) AS n2, CAST(o_orderkey % 2 AS INTEGER) AS ns FROM orders)
    SELECT o_orderkey, CASE WHEN n1 + n2 > 0 AND (n1 = 0 OR n1 <> n2) THEN 'paired input needs matching read1/read2 files'
      WHEN kind = 0 AND (ns = 0 OR n1 + n2 > 0) THEN 'single-end input needs only single files'
      WHEN kind = 1 AND (n1 = 0 OR ns > 0) THEN 'paired input needs only read1/read2 files'
      WHEN kind = 2 AND (n1 = 0 OR ns = 0) THEN 'mixed input needs paired and single files' END AS problem FROM L""",
)
def layout_problems(t: Tables) -> DataFrame:
    """Contradictions between a layout and its file lists."""
    layout = F.element_at(F.array(F.lit("single"), F.lit("paired"), F.lit("mixed")), (F.col("o_orderkey") % 3 + 1).cast("int"))

    def listed(n):
        return F.array_repeat(F.lit("f"), n.cast("int"))

    problem = rd.layout_problem(layout, listed(F.col("o_orderkey") % 4), listed(F.col("o_custkey") % 3), listed(F.col("o_orderkey") % 2))
    return t.orders.select("o_orderkey", problem.alias("problem"))


_STATS_SQL = """Q AS (SELECT l_suppkey AS unit, CAST(2 * count(*) FILTER (l_returnflag = 'A') AS DOUBLE) AS pb, CAST(count(*) FILTER (l_returnflag = 'A') AS DOUBLE) AS pa,
  CAST(50 + l_suppkey % 50 AS DOUBLE) AS p1, CAST(60 + l_suppkey % 7 AS DOUBLE) AS p2, CAST(count(*) FILTER (l_returnflag = 'A') + l_suppkey % 3 AS DOUBLE) AS sb,
  CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(l_suppkey % 5 AS DOUBLE) END AS sa, CAST(16 + l_suppkey % 60 AS DOUBLE) AS s1 FROM lineitem GROUP BY l_suppkey),
D AS (SELECT *, abs(sb - pb / 2) / greatest(sb, pb / 2) AS diff, s1 / least(p1, p2) AS ratio, sa / sb AS retained,
  CASE WHEN sa IS NULL THEN 'single: required field is missing' WHEN sa > sb THEN 'single: non-positive or inconsistent counts' END AS problem FROM Q)"""


@query(
    "mixed_layout_decisions",
    f"""WITH {_STATS_SQL} SELECT unit, problem, round(diff, 9) AS diff, round(ratio, 9) AS ratio, round(retained, 9) AS retained,
    CASE WHEN problem IS NOT NULL THEN 1 ELSE CAST(diff <= 0.001 AS INTEGER) + CAST(s1 <= 30 AS INTEGER) + CAST(ratio < 0.5 AS INTEGER) + CAST(retained < 0.1 AS INTEGER) END AS n_reasons,
    CASE WHEN problem IS NULL AND diff > 0.001 AND s1 > 30 AND ratio >= 0.5 AND retained >= 0.1 THEN 'kept_single_end' ELSE 'excluded_single_end' END AS action FROM D""",
)
def mixed_layout_decisions(t: Tables) -> DataFrame:
    """Whether the single-end branch of a mixed input is kept."""
    supplier = F.col("l_suppkey")
    count = F.count_if(F.col("l_returnflag") == "A").cast("double")
    stats = t.lineitem.groupBy("l_suppkey").agg(count.alias("n")).select(
        supplier.alias("unit"),
        (F.col("n") * 2).alias("paired_before_reads"),
        F.col("n").alias("paired_after_reads"),
        (supplier % 50 + 50).cast("double").alias("paired_read1_mean_length"),
        (supplier % 7 + 60).cast("double").alias("paired_read2_mean_length"),
        (F.col("n") + supplier % 3).cast("double").alias("single_before_reads"),
        F.when(supplier % 11 != 0, (supplier % 5).cast("double")).alias("single_after_reads"),
        (supplier % 60 + 16).cast("double").alias("single_read1_mean_length"),
    )
    judged = rd.mixed_layout_decision(stats)
    return judged.select(
        "unit",
        "problem",
        F.round("count_relative_difference", 9).alias("diff"),
        F.round("single_to_paired_length_ratio", 9).alias("ratio"),
        F.round("single_retained_fraction", 9).alias("retained"),
        F.size("reasons").alias("n_reasons"),
        "action",
    )


@query(
    "unit_mapping",
    """SELECT regexp_replace(c_name, '[^A-Za-z0-9._-]+', '_', 'g') AS id, c_name || '.bam' AS bam, c_name || '.json' AS metadata, 'GCF_' || c_nationkey AS genome, 'ATAC' AS assay, 'placeholder-' || sha256(c_name) AS source FROM customer""",
)
def unit_mapping(t: Tables) -> DataFrame:
    """Mapping rows for the coverage tool."""
    units = t.customer.select(
        F.col("c_name").alias("unit_id"),
        F.concat("c_name", F.lit(".bam")).alias("bam"),
        F.concat("c_name", F.lit(".json")).alias("metadata"),
        F.concat(F.lit("GCF_"), "c_nationkey").alias("genome"),
    )
    return rd.unit_mapping(units)


# ---------------------------------------------------------------- state and plans

STATUS_OF = {"signup": "pending", "view": "downloading", "click": "running", "purchase": "succeeded", "error": "failed"}
_STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_OF.items()) + " END"
SQL_STATES = f"""
E AS (SELECT CAST(user_id AS VARCHAR) AS unit_id, event_id AS seq, ts, {_STATUS_SQL} AS status, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS fingerprint FROM events),
S AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit_id ORDER BY seq DESC) AS rn FROM E) WHERE rn = 1)
"""


def event_table(t: Tables) -> DataFrame:
    """The events as status reports of units."""
    status = F.lit(None).cast("string")
    for kind, name in STATUS_OF.items():
        status = F.when(F.col("event_type") == kind, name).otherwise(status)
    return t.events.select(
        F.col("user_id").cast("string").alias("unit_id"),
        F.col("event_id").alias("seq"),
        "ts",
        status.alias("status"),
        (F.get_json_object("props", "$.k").cast("bigint") % 5).cast("string").alias("fingerprint"),
    )


def state_table(t: Tables) -> DataFrame:
    """Latest status report per unit."""
    return st.latest_per_unit(event_table(t))


@query("latest_states", f"WITH {SQL_STATES} SELECT unit_id, seq, status, CAST(fingerprint AS VARCHAR) AS fingerprint FROM S")
def latest_states(t: Tables) -> DataFrame:
    """Latest report of every unit."""
    return state_table(t).select("unit_id", "seq", "status", "fingerprint")


@query(
    "attempt_counts",
    f"""WITH {SQL_STATES}, D AS (SELECT E.unit_id, S.fingerprint, max(E.seq) FILTER (E.fingerprint <> S.fingerprint) AS changed FROM E JOIN S USING (unit_id) GROUP BY ALL)
    SELECT D.unit_id, CAST(D.fingerprint AS VARCHAR) AS fingerprint, CAST(count(*) AS BIGINT) AS attempts FROM E JOIN D ON E.unit_id = D.unit_id AND (changed IS NULL OR E.seq > changed) GROUP BY ALL""",
)
def attempt_counts(t: Tables) -> DataFrame:
    """Attempts of the latest work of every unit."""
    return st.attempts_per_unit(event_table(t).select("unit_id", "seq", "fingerprint"))


_STATUS_VALUES = ", ".join(f"('{s}')" for s in st.STATUSES)


@query(
    "status_counts",
    f"""WITH {SQL_STATES}, W AS (SELECT coalesce(status, 'pending') AS status FROM (SELECT CAST(c_custkey AS VARCHAR) AS unit_id FROM customer) LEFT JOIN S USING (unit_id))
    SELECT v.status, CAST(count(W.status) AS BIGINT) AS n FROM (VALUES {_STATUS_VALUES}) v(status) LEFT JOIN W ON W.status = v.status GROUP BY v.status""",
)
def status_counts(t: Tables) -> DataFrame:
    """Units per status, unknown ones pending."""
    return st.status_counts(state_table(t), t.customer.select(F.col("c_custkey").cast("string").alias("unit_id")))


@query(
    "report_counts",
    f"WITH {SQL_STATES} SELECT CAST(count(*) FILTER (status = 'succeeded') AS BIGINT) AS succeeded, CAST(count(*) FILTER (status = 'failed') AS BIGINT) AS failed, CAST(0 AS BIGINT) AS skipped FROM S",
)
def report_counts(t: Tables) -> DataFrame:
    """Counts of a build report."""
    return st.report_counts(state_table(t))


_NOW_SQL = "(SELECT max(ts) FROM events)"


def _now(t: Tables) -> Column:
    """Time of the last event, as a scalar subquery."""
    return t.events.agg(F.max("ts")).scalar()


@query(
    "stale_claims",
    f"WITH {SQL_STATES} SELECT unit_id, status FROM S WHERE status IN ('downloading', 'running') AND epoch_us({_NOW_SQL}) - epoch_us(ts) > CAST(14400000000 AS BIGINT)",
)
def stale_claims(t: Tables) -> DataFrame:
    """Active units whose claim is older than four hours."""
    states = state_table(t).withColumnRenamed("ts", "started_at")
    return st.stale_claims(states, _now(t), 14_400).select("unit_id", "status")


_PLAN_SQL = f"""{SQL_STATES}, I AS (SELECT CAST(c_custkey AS VARCHAR) AS unit_id, CAST(c_custkey % 5 AS BIGINT) AS fp FROM customer),
J AS (SELECT I.unit_id, I.fp, S.status, S.unit_id IS NOT NULL AS known, coalesce(S.fingerprint = I.fp, FALSE) AS same,
  coalesce(epoch_us({_NOW_SQL}) - epoch_us(S.ts) > CAST(14400000000 AS BIGINT), FALSE) AS stale, CAST(I.unit_id AS BIGINT) % 2 = 0 AS valid FROM I LEFT JOIN S USING (unit_id)),
A AS (SELECT *, CASE WHEN status = 'succeeded' AND same AND valid THEN 'reuse' WHEN status = 'failed' AND same THEN 'skip_failed'
  WHEN status IN ('downloading', 'running') AND NOT stale THEN 'already_running' ELSE 'claim' END AS action, coalesce(status = 'succeeded', FALSE) AND same AND NOT valid AS force FROM J)"""


def resume_items(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Items, states and output checks for the resume plan."""
    items = t.customer.select(
        F.col("c_custkey").cast("string").alias("unit_id"), (F.col("c_custkey") % 5).cast("string").alias("fingerprint")
    )
    states = state_table(t).select(
        "unit_id", "status", F.lit("work").alias("phase"), "fingerprint", F.lit(2).alias("attempts"), F.col("ts").alias("started_at")
    )
    valid = t.customer.select(F.col("c_custkey").cast("string").alias("unit_id"), (F.col("c_custkey") % 2 == 0).alias("valid"))
    return items, states, valid


@query(
    "resume_plan",
    f"""WITH {_PLAN_SQL} SELECT unit_id, CAST(fp AS VARCHAR) AS fingerprint, action, CASE WHEN action = 'claim' THEN CASE WHEN same THEN '3' ELSE '1' END END AS attempts,
    NOT known OR force OR NOT same OR coalesce(status = 'failed', FALSE) AS reset_outputs, action = 'claim' AND known AND (NOT same OR force) AS archive_previous FROM A""",
)
def resume_plan(t: Tables) -> DataFrame:
    """What to do with every item."""
    items, states, valid = resume_items(t)
    plan = st.plan_resume(items, states, valid, _now(t), stale_seconds=14_400)
    return plan.select(
        "unit_id", "fingerprint", "action", F.col("attempts").cast("string").alias("attempts"), "reset_outputs", "archive_previous"
    )


@query(
    "outputs_valid",
    """WITH O AS (SELECT CAST(o_custkey AS VARCHAR) AS unit_id, o_custkey AS ck, bool_and(o_orderkey % 9 <> 0 AND (o_orderkey % 4 <> 0 OR o_orderkey % 8 = 0)) AS ok FROM orders GROUP BY o_custkey)
    SELECT unit_id, ok AND ck % 6 <> 0 AS valid FROM O""",
)
def outputs_valid(t: Tables) -> DataFrame:
    """Whether the outputs of every unit are unchanged or still match their checksum."""
    path = F.concat(F.lit("/out/"), F.col("o_orderkey"))
    outputs = t.orders.select(
        F.col("o_custkey").cast("string").alias("unit_id"),
        F.lit("coverage").alias("role"),
        path.alias("path"),
        F.lit(5).alias("size"),
        F.col("o_orderdate").alias("modified"),
        F.lit("good").alias("sha256"),
    )
    changed = F.col("o_orderkey") % 4 == 0
    now = t.orders.select(
        path.alias("path"),
        F.when(F.col("o_orderkey") % 9 == 0, 0).when(changed, 6).otherwise(5).alias("size"),
        F.col("o_orderdate").alias("modified"),
        F.when(F.col("o_orderkey") % 8 == 0, "good").otherwise("bad").alias("sha256"),
    )
    owners = t.orders.select("o_custkey").distinct()
    genomes = owners.select(F.col("o_custkey").cast("string").alias("unit_id"), F.concat(F.lit("/g/"), "o_custkey").alias("fasta"))
    fastas = owners.filter("o_custkey % 6 <> 0").select(
        F.concat(F.lit("/g/"), "o_custkey").alias("path"),
        F.lit(1).alias("size"),
        F.lit(None).cast(now.schema["modified"].dataType).alias("modified"),
        F.lit("g").alias("sha256"),
    )
    return st.outputs_valid(outputs, genomes, now.unionByName(fastas))


KIND_OF = {"signup": "requeue", "view": "claim", "click": "phase", "purchase": "succeed", "error": "fail"}


def fold_input(t: Tables) -> DataFrame:
    """The events as state events: claims number themselves, the others guess a claim."""
    kind = F.lit(None).cast("string")
    for source, name in KIND_OF.items():
        kind = F.when(F.col("event_type") == source, name).otherwise(kind)
    number = F.get_json_object("props", "$.k").cast("bigint")
    return t.events.select(
        F.col("user_id").cast("string").alias("unit_id"),
        F.col("event_id").alias("seq"),
        "ts",
        kind.alias("kind"),
        (number % 2).cast("string").alias("claim_id"),
        (number % 3).cast("string").alias("fingerprint"),
        F.lit("x1").alias("execution_id"),
        F.when(number % 2 == 0, "processing").otherwise("downloading-input").alias("payload"),
        (number % 11 == 0).alias("force"),
        (number % 4 == 0).alias("retry_failed"),
        (number % 7 == 0).alias("reclaim"),
    )


#: The fold as a recursion: step i takes the i-th event of every unit.
SQL_FOLD = """
E AS (SELECT CAST(user_id AS VARCHAR) AS unit_id, event_id AS seq, ts, k,
    CASE event_type WHEN 'signup' THEN 'requeue' WHEN 'view' THEN 'claim' WHEN 'click' THEN 'phase' WHEN 'purchase' THEN 'succeed' WHEN 'error' THEN 'fail' END AS kind,
    CAST(k % 2 AS VARCHAR) AS claim, CAST(k % 3 AS VARCHAR) AS print, CASE WHEN k % 2 = 0 THEN 'processing' ELSE 'downloading-input' END AS payload,
    row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events)),
F AS (
  SELECT DISTINCT unit_id, CAST(0 AS BIGINT) AS i, CAST(NULL AS BIGINT) AS seq, CAST(NULL AS VARCHAR) AS kind, CAST(NULL AS VARCHAR) AS reason, CAST(NULL AS VARCHAR) AS status,
    CAST(NULL AS VARCHAR) AS phase, CAST(NULL AS INTEGER) AS attempts, CAST(NULL AS VARCHAR) AS fingerprint, CAST(NULL AS VARCHAR) AS claim_id, CAST(NULL AS TIMESTAMP) AS started, false AS is_last FROM E
  UNION ALL
  SELECT unit_id, i, seq, kind, reason,
    CASE WHEN reason IS NOT NULL THEN status WHEN kind = 'claim' THEN 'downloading' WHEN kind = 'requeue' THEN 'pending' WHEN kind = 'succeed' THEN 'succeeded' WHEN kind = 'fail' THEN 'failed'
      WHEN payload = 'processing' THEN 'running' ELSE 'downloading' END,
    CASE WHEN reason IS NOT NULL THEN phase WHEN kind = 'claim' THEN 'resolving-genome' WHEN kind = 'requeue' THEN 'interrupted' WHEN kind = 'succeed' THEN 'completed' WHEN kind = 'fail' THEN 'failed'
      ELSE payload END,
    CASE WHEN reason IS NOT NULL OR kind <> 'claim' THEN attempts WHEN same THEN attempts + 1 ELSE 1 END,
    CASE WHEN reason IS NULL AND kind = 'claim' THEN print ELSE fingerprint END,
    CASE WHEN reason IS NOT NULL THEN claim_id WHEN kind = 'claim' THEN claim WHEN kind = 'requeue' THEN NULL ELSE claim_id END,
    CASE WHEN reason IS NULL AND kind = 'claim' THEN ts ELSE started END,
    i = n
  FROM (SELECT *, CASE
      WHEN kind = 'claim' AND same AND k % 11 <> 0 AND status = 'succeeded' THEN 'reusable success'
      WHEN kind = 'claim' AND same AND k % 11 <> 0 AND status = 'failed' AND k % 4 <> 0 THEN 'failed before, retry not requested'
      WHEN kind = 'claim' AND busy AND k % 7 <> 0 AND epoch(ts) - epoch(started) <= 7200 THEN 'already running'
      WHEN kind = 'requeue' AND status IS NULL THEN 'no state to requeue'
      WHEN kind = 'requeue' AND NOT busy THEN 'not active'
      WHEN kind IN ('phase', 'succeed', 'fail') AND (status IS NULL OR claim_id IS DISTINCT FROM claim) THEN 'claim was replaced'
      WHEN kind = 'phase' AND NOT busy THEN 'not allowed while ' || status END AS reason
    FROM (SELECT E.*, F.status, F.phase, F.attempts, F.fingerprint, F.claim_id, F.started,
        F.status IS NOT NULL AND F.fingerprint = E.print AS same, coalesce(F.status IN ('downloading', 'ready', 'submitted', 'running'), false) AS busy
      FROM F JOIN E ON E.unit_id = F.unit_id AND E.i = F.i + 1))
)"""


@query("state_fold", f"WITH RECURSIVE {SQL_FOLD} SELECT unit_id, seq, kind, reason IS NULL AS accepted, reason, status, phase, attempts, claim_id, is_last FROM F WHERE i > 0")
def state_fold(t: Tables) -> DataFrame:
    """Verdict and state after every event."""
    folded = st.fold_events(fold_input(t), stale_seconds=7_200)
    return folded.select("unit_id", "seq", "kind", "accepted", "reason", "status", "phase", "attempts", "claim_id", "is_last")


@query("folded_states", f"WITH RECURSIVE {SQL_FOLD} SELECT unit_id, status, phase, attempts, fingerprint, claim_id FROM F WHERE is_last AND status IS NOT NULL")
def folded_states(t: Tables) -> DataFrame:
    """Final state of every unit after the fold."""
    return st.final_states(st.fold_events(fold_input(t), stale_seconds=7_200, last_only=True)).select(
        "unit_id", "status", "phase", "attempts", "fingerprint", "claim_id"
    )


# ---------------------------------------------------------------- requests


@query(
    "request_chunks",
    """WITH N AS (SELECT c_name, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer)
    SELECT CAST(i // 50 AS BIGINT) AS chunk, CAST(count(*) AS BIGINT) AS n, string_agg('"' || regexp_replace(c_name, '#', '_') || '"[Accession]', ' OR ' ORDER BY i) AS request FROM N GROUP BY 1""",
)
def request_chunks(t: Tables) -> DataFrame:
    """Search texts for chunks of fifty accessions."""
    names = t.customer.select(F.regexp_replace("c_name", "#", "_").alias("id"), F.col("c_custkey").alias(ORD))
    numbers = t.region.select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_regionkey").cast("bigint").alias(ORD))
    return rq.resolve_requests(rq.request_ids(names.unionByName(numbers)))


@query(
    "unsafe_request_ids",
    "SELECT DISTINCT c_name AS key FROM customer WHERE NOT regexp_full_match(c_name, '[A-Za-z0-9][A-Za-z0-9_.:-]*')",
)
def unsafe_request_ids(t: Tables) -> DataFrame:
    """Identifiers that must not be put into a query."""
    return rq.unsafe_ids(rq.request_ids(t.customer.select(F.col("c_name").alias("id"), F.col("c_custkey").alias(ORD)))).select("key")


@query(
    "page_offsets",
    """WITH Q AS (SELECT source AS query, CAST(sum(n_chars) AS BIGINT) AS c FROM documents GROUP BY source)
    SELECT query, CAST(unnest(range(0, c, 5000)) AS BIGINT) AS "offset" FROM Q""",
)
def page_offsets(t: Tables) -> DataFrame:
    """Offsets of result pages."""
    counts = t.documents.groupBy(F.col("source").alias("query")).agg(F.sum("n_chars").alias("count"))
    return rq.page_offsets(counts).select("query", "offset")


@query(
    "oversized_searches",
    "SELECT source AS key, sum(n_chars) || ' records, above the limit of 10000' AS detail FROM documents GROUP BY source HAVING sum(n_chars) > 10000",
)
def oversized_searches(t: Tables) -> DataFrame:
    """Searches above the id ceiling."""
    counts = t.documents.groupBy(F.col("source").alias("query")).agg(F.sum("n_chars").alias("count"))
    return rq.over_limit(counts, 10_000).select("key", "detail")


# ---------------------------------------------------------------- manifests and reports

_MANIFEST_SQL = f"""{SQL_STATES}, M AS (SELECT CAST(c_custkey AS VARCHAR) AS unit_id, CAST(c_custkey % 5 AS VARCHAR) AS fingerprint, 'e2' AS execution_id,
  CASE WHEN S.fingerprint = c_custkey % 5 THEN S.status ELSE 'pending' END AS status, CASE WHEN S.fingerprint = c_custkey % 5 THEN 'work' ELSE 'waiting' END AS phase,
  CASE WHEN S.fingerprint = c_custkey % 5 THEN 2 ELSE 0 END AS attempts, CASE WHEN S.fingerprint = c_custkey % 5 THEN 'a/' || S.unit_id || '.bw' END AS artifact
  FROM customer LEFT JOIN S ON S.unit_id = CAST(c_custkey AS VARCHAR) WHERE c_custkey % 2 = 0)"""


def current_manifest(t: Tables) -> DataFrame:
    """Manifest rows of an execution over every second customer."""
    items, states, _ = resume_items(t)
    files = F.create_map(
        F.lit("coverage"), F.struct(F.concat(F.lit("/w/out/a/"), "unit_id", F.lit(".bw")).alias("path"), F.lit(5).alias("size"))
    )
    rows = mf.manifest_rows(
        items.filter("CAST(unit_id AS BIGINT) % 2 = 0"),
        states.withColumn("output_files", files),
        execution_id="e2",
        processor_identity="demo:v1",
        output_root="/w/out",
    )
    return rows.withColumn("artifact", F.col("artifacts")["coverage"]["path"]).drop("artifacts")


@query("manifest_rows", f"WITH {_MANIFEST_SQL} SELECT * FROM M")
def manifest_rows(t: Tables) -> DataFrame:
    """Manifest rows of the current execution."""
    return current_manifest(t).select("unit_id", "fingerprint", "execution_id", "status", "phase", "attempts", "artifact")


@query(
    "synced_manifest",
    f"""WITH {_MANIFEST_SQL}, P AS (SELECT CAST(c_custkey AS VARCHAR) AS unit_id, 'e1' AS execution_id, 'succeeded' AS status FROM customer)
    SELECT unit_id, execution_id, status FROM M UNION ALL SELECT * FROM P WHERE unit_id NOT IN (SELECT unit_id FROM M)""",
)
def synced_manifest(t: Tables) -> DataFrame:
    """Cumulative manifest after the current execution."""
    position = F.col("unit_id").cast("bigint").alias(ORD)
    previous = t.customer.select(F.col("c_custkey").cast("string").alias("unit_id")).select(
        "unit_id", F.lit("e1").alias("execution_id"), F.lit("succeeded").alias("status"), position
    )
    current = current_manifest(t).select("unit_id", "execution_id", "status", position)
    return mf.sync_manifest(previous, current).drop(ORD)


@query(
    "status_report",
    f"""WITH {SQL_STATES}, X AS (SELECT CAST(o_custkey AS VARCHAR) AS unit_id, arg_max('exec' || (o_orderkey % 4), struct_pack(d := o_orderkey % 4)) AS execution_id FROM orders GROUP BY o_custkey),
    Y AS (SELECT unit_id, execution_id FROM X UNION ALL SELECT unit_id, NULL FROM S WHERE unit_id NOT IN (SELECT unit_id FROM X))
    SELECT unit_id, execution_id, coalesce(status, 'pending') AS status, CASE WHEN S.unit_id IS NULL THEN 'waiting' ELSE 'work' END AS phase,
      CASE WHEN S.fingerprint = 1 THEN 'R' || unit_id WHEN S.fingerprint = 2 THEN 'P' || unit_id WHEN S.unit_id IS NOT NULL THEN 'S' || unit_id END AS genome_accession,
      CASE WHEN status = 'failed' THEN 'boom' END AS error FROM Y LEFT JOIN S USING (unit_id)""",
)
def status_report(t: Tables) -> DataFrame:
    """Status of the last item of every unit."""
    items = t.orders.select(
        F.concat(F.lit("exec"), F.col("o_orderkey") % 4).alias("execution_id"), F.col("o_custkey").cast("string").alias("unit_id")
    ).distinct().withColumn("item_id", F.col("unit_id"))
    executions = items.select("execution_id").distinct().withColumn("created_at", F.concat(F.lit("2026-01-0"), F.substring("execution_id", 5, 1)))
    states = state_table(t).select(
        "unit_id",
        "status",
        F.lit("work").alias("phase"),
        F.lit(2).alias("attempts"),
        F.when(F.col("fingerprint") == "1", F.concat(F.lit("R"), "unit_id")).alias("result_genome"),
        F.when(F.col("fingerprint") == "2", F.concat(F.lit("P"), "unit_id")).alias("prepared_genome"),
        F.concat(F.lit("S"), "unit_id").alias("state_genome"),
        F.when(F.col("status") == "failed", "trace\n boom \n \n").alias("error"),
    )
    report = mf.status_report(items, states, executions)
    return report["units"].select("unit_id", "execution_id", "status", "phase", "genome_accession", "error")


_PUBLISH_SQL = f"""{SQL_STATES}, U AS (SELECT CAST(c_custkey AS VARCHAR) AS unit_id, c_custkey AS ck, n_name, c_nationkey, S.status, S.fingerprint,
  CASE WHEN c_custkey % 10 = 1 THEN 'must link exactly one sample' WHEN coalesce(S.status, '') <> 'succeeded' THEN 'has not completed successfully'
   WHEN S.fingerprint = 3 THEN 'must have exactly one coverage output' WHEN c_custkey % 10 = 2 THEN 'description is missing' WHEN c_custkey % 10 = 3 THEN 'unit and genome taxid differ' END AS problem
  FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN S ON S.unit_id = CAST(c_custkey AS VARCHAR))"""


def _publish(t: Tables) -> tuple[DataFrame, DataFrame]:
    number = F.col("c_custkey")
    items = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        number.cast("string").alias("unit_id"),
        F.array(number.cast("string")).alias("experiment_accessions"),
        F.when(number % 10 == 1, F.array(F.lit("a"), F.lit("b"))).otherwise(F.array(F.concat(F.lit("SRS"), number))).alias("sra_sample_accessions"),
        F.col("n_name").alias("scientific_name"),
        F.col("c_nationkey").cast("bigint").alias("taxid"),
    )
    numbered = F.col("unit_id").cast("bigint")
    nation = items.select("unit_id", "taxid", "scientific_name")
    outputs = (
        F.when(F.col("fingerprint") == "1", F.create_map(F.lit("coverage"), F.lit("/o/c.bw"), F.lit("coverage_minus"), F.lit("/o/m.bw")))
        .when(F.col("fingerprint") == "3", F.create_map(F.lit("coverage_plus"), F.lit("/o/p.bw"), F.lit("coverage_minus"), F.lit("/o/m.bw")))
        .otherwise(F.create_map(F.lit("coverage_plus"), F.lit("/o/p.bw"), F.lit("report"), F.lit("/o/r.txt")))
    )
    states = state_table(t).join(nation, "unit_id").select(
        "unit_id",
        "status",
        outputs.alias("outputs"),
        F.when(numbered % 10 == 3, F.lit(-1)).otherwise(F.col("taxid")).cast("bigint").alias("genome_taxid"),
        F.when(F.col("taxid") % 6 == 0, F.concat(F.lit("GCF_"), numbered % 2)).otherwise(F.concat(F.lit("GCF_"), "taxid")).alias("genome_accession"),
        F.lit("").alias("genome_species"),
        F.lit("/g.fa").alias("genome_fasta"),
    )
    descriptions = t.customer.filter("c_custkey % 10 <> 2").select(number.cast("string").alias("experiment"))
    return mf.publish_plan(items, states, descriptions)


@query(
    "publish_rows",
    f"""WITH {_PUBLISH_SQL} SELECT unit_id AS experiment, 'SRS' || ck AS sample_id, n_name AS species, n_name || '.fasta.gz' AS species_file,
    CASE WHEN fingerprint = 1 THEN '/o/c.bw' ELSE '/o/p.bw' END AS coverage_source, 'bigWig/' || unit_id || '.bw' AS coverage_target FROM U WHERE problem IS NULL""",
)
def publish_rows(t: Tables) -> DataFrame:
    """Experiments that can be published."""
    rows, _ = _publish(t)
    return rows.select("experiment", "sample_id", "species", "species_file", "coverage_source", "coverage_target")


@query(
    "publish_problems",
    f"""WITH {_PUBLISH_SQL}, R AS (SELECT n_name || '.fasta.gz' AS f, 'GCF_' || CASE WHEN c_nationkey % 6 = 0 THEN ck % 2 ELSE c_nationkey END AS acc FROM U WHERE problem IS NULL)
    SELECT unit_id AS key, problem AS detail FROM U WHERE problem IS NOT NULL
    UNION ALL SELECT f, 'collision: ' || min(acc) || ' and ' || max(acc) FROM R GROUP BY f HAVING min(acc) <> max(acc)""",
)
def publish_problems(t: Tables) -> DataFrame:
    """Why experiments cannot be published, and colliding species files."""
    _, problems = _publish(t)
    return problems.select("key", "detail")


@query(
    "merged_dataset",
    """SELECT c_custkey AS experiment, c_custkey % 2 = 0 AS requested_by_latest_execution, CASE WHEN c_custkey % 2 = 0 THEN 'new' ELSE 'old' END AS origin
    FROM customer""",
)
def merged_dataset(t: Tables) -> DataFrame:
    """Published records of all executions with a flag for the latest."""
    keys = t.customer.select(F.col("c_custkey").alias("experiment"), F.col("c_custkey").alias(ORD))
    old = keys.filter("experiment % 3 = 0 OR experiment % 2 = 1").withColumn("origin", F.lit("old"))
    new = keys.filter("experiment % 2 = 0").withColumn("origin", F.lit("new"))
    return mf.merge_dataset(old, new).drop(ORD)


@query(
    "genome_inventory",
    """WITH B AS (SELECT 'GCF_' || n_nationkey AS accession, CAST(n_nationkey AS BIGINT) AS taxid, n_name AS name, 0 AS r FROM nation WHERE n_nationkey < 15
      UNION ALL SELECT DISTINCT 'GCF_' || s_nationkey, CAST(s_nationkey AS BIGINT), 'used', 1 FROM supplier)
    SELECT accession, taxid, name AS scientific_name, taxid % 3 <> 0 AS available FROM (SELECT *, row_number() OVER (PARTITION BY accession ORDER BY r) AS rn FROM B) WHERE rn = 1""",
)
def genome_inventory(t: Tables) -> DataFrame:
    """Registered genomes and those only units name."""
    def rows(df, key, name):
        return df.select(
            F.col(key).cast("bigint").alias("taxid"),
            name.alias("scientific_name"),
            F.concat(F.lit("GCF_"), key).alias("accession"),
            F.concat(F.lit("/g/"), key).alias("fasta"),
        )

    locked = rows(t.nation.filter("n_nationkey < 15"), "n_nationkey", F.col("n_name"))
    used = rows(t.supplier.select("s_nationkey").distinct(), "s_nationkey", F.lit("used"))
    files = t.nation.filter("n_nationkey % 3 <> 0").select(F.concat(F.lit("/g/"), "n_nationkey").alias("path"), F.lit(4).alias("size"))
    return mf.genome_inventory(locked, used, files).select("accession", "taxid", "scientific_name", "available")


@query(
    "output_problems",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE CAST(o_orderkey % 6 AS INTEGER) WHEN 0 THEN 'failed badly' WHEN 1 THEN 'success without outputs' WHEN 2 THEN 'outside its directory: b'
      WHEN 3 THEN 'path used twice: /w/' || o_orderkey || '/x.bw' ELSE 'blank output role' END AS detail FROM orders WHERE o_orderkey % 6 < 5""",
)
def output_problems(t: Tables) -> DataFrame:
    """Results that break the output rules."""
    kind = F.col("o_orderkey") % 6
    outputs = (
        F.when(kind == 2, F.create_map(F.lit("a"), F.lit("ok.bw"), F.lit("b"), F.lit("../elsewhere/x")))
        .when(kind == 3, F.create_map(F.lit("a"), F.lit("x.bw"), F.lit("b"), F.lit("./y/../x.bw")))
        .when(kind == 4, F.create_map(F.lit(" "), F.lit("ok.bw")))
        .when(kind == 5, F.create_map(F.lit("a"), F.concat(F.lit("/w/"), "o_orderkey", F.lit("/ok.bw"))))
    )
    results = t.orders.select(
        F.col("o_orderkey").cast("string").alias("unit_id"),
        (kind != 0).alias("success"),
        F.when(kind == 0, "failed badly").alias("message"),
        F.concat(F.lit("/w/"), "o_orderkey").alias("output_dir"),
        outputs.alias("outputs"),
    )
    return mf.output_problems(results).select("key", "detail")


SQL_PATHS = """W AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path, strlen(html) AS size FROM pages),
P AS (SELECT '/' || path AS path, size FROM W), H AS (SELECT DISTINCT '/' || split_part(path, '/', 1) AS root FROM W)"""


@query(
    "path_usage",
    f"""WITH {SQL_PATHS} SELECT root, CAST(sum(size) AS BIGINT) AS bytes, round(sum(size) / 1e9, 9) AS size_gb
    FROM H JOIN P ON P.path = root OR P.path LIKE replace(root, '_', '\\_') || '/%' ESCAPE '\\' GROUP BY root""",
)
def path_usage(t: Tables) -> DataFrame:
    """Bytes below each host, with nested roots counted once."""
    path = F.regexp_replace("url", "^[a-z]+://", "")
    files = t.pages.select(F.concat(F.lit("/"), path).alias("path"), F.octet_length("html").alias("size"))
    hosts = t.pages.select(F.concat(F.lit("/"), F.split_part(path, F.lit("/"), F.lit(1))).alias("root"))
    nested = t.pages.select(F.concat(F.lit("/"), path).alias("root")).filter(F.size(F.split("root", "/")) > 2)
    usage = mf.path_usage(files, hosts.unionByName(nested))
    return usage.select("root", "bytes", F.round("size_gb", 9).alias("size_gb"))


@query(
    "supplementary_files",
    """WITH D AS (SELECT 'GSM' || doc_id AS owner, 'ftp://x/' || lang || '/' || source || '.gz' AS url, doc_id FROM documents)
    SELECT arg_max(owner, doc_id) AS geo_accession, url, regexp_extract(url, '([^/]+)$', 1) AS filename, min(doc_id) AS position FROM D GROUP BY url""",
)
def supplementary_files(t: Tables) -> DataFrame:
    """Distinct files by URL: first position, last owner."""
    listed = t.documents.select(
        F.concat(F.lit("GSM"), "doc_id").alias("geo_accession"),
        F.concat(F.lit("ftp://x/"), "lang", F.lit("/"), "source", F.lit(".gz")).alias("url"),
        F.col("doc_id").alias(ORD),
    )
    return distinct_supplementary(listed).select("geo_accession", "url", "filename", F.col(ORD).alias("position"))


def _demo_processor(fastq: dict, genome: dict, context: dict) -> pr.ProcessingResult:
    if fastq["n_files"] % 7 == 0:
        raise ValueError("bad input")
    return pr.ProcessingResult(
        True, {"coverage": f"{genome['accession']}.bw"}, {"files": fastq["n_files"]}, {"demo": "1"}
    )


@query(
    "processed_units",
    """WITH N AS (SELECT conv_id, CAST(count(*) AS BIGINT) AS n FROM conversations GROUP BY conv_id)
    SELECT CAST(conv_id AS VARCHAR) AS unit_id, CASE WHEN n % 7 = 0 THEN 'failed' ELSE 'succeeded' END AS status,
    CASE WHEN n % 7 <> 0 THEN '/w/' || conv_id || '/GCF_' || (conv_id % 5) || '.bw' END AS coverage, CASE WHEN n % 7 <> 0 THEN '{"files": ' || n || '}' END AS metrics FROM N""",
)
def processed_units(t: Tables) -> DataFrame:
    """A processor run over every unit, with failures captured."""
    units = t.conversations.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_files")).select(
        F.col("conv_id").cast("string").alias("unit_id"),
        F.struct("n_files").alias("fastq"),
        F.struct(F.concat(F.lit("GCF_"), F.col("conv_id") % 5).alias("accession")).alias("genome"),
        F.struct(F.concat(F.lit("/w/"), "conv_id").alias("output_dir")).alias("context"),
    )
    done = pr.run_units(units, _demo_processor, need_files=False)
    return done.select("unit_id", "status", F.col("outputs")["coverage"].alias("coverage"), "metrics")


@query(
    "description_problems",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN o_orderkey % 5 = 0 THEN 'requires exactly one experiment per unit' ELSE 'no description is available' END AS detail
    FROM orders WHERE o_orderkey % 5 = 0 OR o_custkey % 7 = 0""",
)
def description_problems(t: Tables) -> DataFrame:
    """Units a describing processor cannot take."""
    one = F.concat(F.lit("SRX"), "o_custkey")
    units = t.orders.select(
        F.col("o_orderkey").cast("string").alias("unit_id"),
        F.when(F.col("o_orderkey") % 5 == 0, F.array(one, F.lit("other"))).otherwise(F.array(one)).alias("experiment_accessions"),
    )
    known = t.customer.filter("c_custkey % 7 <> 0").select(F.concat(F.lit("SRX"), "c_custkey").alias("experiment"))
    return pr.description_problems(units, known).select("key", "detail")


@query(
    "planned_units",
    f"""WITH {SQL_PRINTS}, {SQL_STATES.strip()}, T AS (SELECT FP.unit_id, FP.fingerprint, S.status, CAST(S.fingerprint AS BIGINT) % 2 = 0 AS same FROM FP LEFT JOIN S ON S.unit_id = replace(FP.unit_id, 'SAMN', ''))
    SELECT unit_id, fingerprint, CASE WHEN status = 'succeeded' AND same THEN 'reuse' WHEN status = 'failed' AND same THEN 'skip_failed' WHEN status IN ('downloading', 'running') THEN 'already_running' ELSE 'claim' END AS action FROM T""",
)
def planned_units(t: Tables) -> DataFrame:
    """Units of the clean catalog, fingerprinted and planned against the unit states."""
    units = fingerprints(t).select("unit_id", "fingerprint")
    reported = state_table(t).withColumn("unit_id", F.concat(F.lit("SAMN"), "unit_id"))
    states = reported.join(units.withColumnRenamed("fingerprint", "_print"), "unit_id").select(
        "unit_id",
        "status",
        F.lit("work").alias("phase"),
        F.when(F.col("fingerprint").cast("int") % 2 == 0, F.col("_print")).otherwise(F.lit("old")).alias("fingerprint"),
        F.lit(1).alias("attempts"),
        F.col("ts").alias("started_at"),
    )
    plan = st.plan_resume(units, states, None, _now(t))
    return plan.select("unit_id", "fingerprint", "action")

