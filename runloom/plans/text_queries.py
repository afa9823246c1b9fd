"""Scalar function queries on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import identity, names, text, values
from ..operators.descriptions import experiment_field
from .registry import Tables, query

# White space as the engine sees it, spelled for SQL.
WS = r"[\t-\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000} ]"


def _squeeze(value: str) -> str:
    return f"trim(regexp_replace({value}, '{WS}+', ' ', 'g'))"


def _fold(value: str) -> str:
    return f"replace(replace(lower({value}), 'ß', 'ss'), 'ς', 'σ')"


@query(
    "normalized_texts",
    f"""SELECT doc_id, md5({_squeeze('text')}) AS squeezed, md5({_squeeze(_fold("regexp_replace(text, '[_/-]+', ' ', 'g')"))}) AS folded,
    md5(regexp_replace(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'), '[^A-Za-z0-9._-]+', '_', 'g')) AS identifier,
    {_fold(_squeeze("source || '/' || lang"))} IN ('src0/en', 'na', 'unknown') AS placeholder,
    regexp_full_match(source, '[A-Za-z0-9][A-Za-z0-9_.:-]*') AS safe, regexp_full_match(CAST(doc_id AS VARCHAR), '[0-9]+') AS numeric
    FROM documents""",
)
def normalized_texts(t: Tables) -> DataFrame:
    """Normalization of whole documents, compared through digests."""
    body = F.col("text")
    place = text.fold_case(text.squeeze(F.concat_ws("/", "source", "lang")))
    return t.documents.select(
        "doc_id",
        F.md5(text.squeeze(body)).alias("squeezed"),
        F.md5(text.normalized_name(body)).alias("folded"),
        F.md5(text.safe_identifier(body)).alias("identifier"),
        (text.is_placeholder(F.concat_ws("/", "source", "lang")) | (place == "src0/en")).alias("placeholder"),
        text.is_safe_accession(F.col("source")).alias("safe"),
        text.is_numeric_id(F.col("doc_id").cast("string")).alias("numeric"),
    )


@query(
    "tissue_keys",
    f"""SELECT conv_id, turn, md5({_fold(f"regexp_replace({_squeeze('t')}, '^[[][^]]+[]]{WS}*', '')")}) AS tissue_key
    FROM (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN '[' || role || ']  ' ELSE '' END || text AS t FROM conversations)""",
)
def tissue_keys(t: Tables) -> DataFrame:
    """Comparison form of labelled values."""
    labelled = F.concat(
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("["), F.col("role"), F.lit("]  "))).otherwise(F.lit("")),
        F.col("text"),
    )
    return t.conversations.select("conv_id", "turn", F.md5(text.tissue_key(labelled)).alias("tissue_key"))


@query(
    "order_markup",
    """SELECT o_orderkey, 'of ' || o_orderpriority || ' & "' || o_orderstatus || '" < ' || o_custkey AS plain,
    o_orderpriority || '  <' || o_custkey AS escaped FROM orders""",
)
def order_markup(t: Tables) -> DataFrame:
    """Texts with tags and entities of several rounds, and texts with entities alone."""
    marked = F.concat(
        F.lit("<p class='a b'>of <B>"), "o_orderpriority", F.lit("</B>\n &amp;amp; &quot;"), "o_orderstatus", F.lit("&quot; &amp;lt; <br/>"), "o_custkey", F.lit("</p>")
    )
    escaped = F.concat("o_orderpriority", F.lit("  &lt;"), "o_custkey")
    return t.orders.select("o_orderkey", text.without_markup(marked).alias("plain"), text.without_markup(escaped).alias("escaped"))


@query("plain_page_texts")
def plain_page_texts(t: Tables) -> DataFrame:
    """Visible text of whole pages: entities decoded, tags removed."""
    return t.pages.select("page_id", F.md5(text.without_markup(F.col("html"))).alias("text_md5"))


@query(
    "lenient_values",
    """SELECT event_id, CAST(TRY_CAST(k AS BIGINT) AS VARCHAR) AS k_int, CAST(CAST(trunc(TRY_CAST(v AS DOUBLE)) AS BIGINT) AS VARCHAR) AS v_int,
    TRY_CAST(v AS DOUBLE) AS v_float, round(TRY_CAST(k AS BIGINT) / 1000000000.0, 12) AS k_gb,
    CAST(round(value * 1000) AS BIGINT) * 1000000 AS value_bytes,
    CASE WHEN event_id % 3 = 0 THEN k ELSE k || ' ' || event_type END AS with_unit
    FROM (SELECT *, CASE WHEN event_id % 5 = 0 THEN '' ELSE json_extract_string(props, '$.k') END AS k,
          CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS v FROM events)""",
)
def lenient_values(t: Tables) -> DataFrame:
    """Conversions that give null instead of failing."""
    events = t.events.withColumn(
        "k", F.when(F.col("event_id") % 5 == 0, F.lit("")).otherwise(F.get_json_object("props", "$.k"))
    ).withColumn("v", F.when(F.col("event_id") % 7 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")))
    unit = F.when(F.col("event_id") % 3 != 0, F.col("event_type"))
    return events.select(
        "event_id",
        values.lenient_int(F.col("k")).cast("string").alias("k_int"),
        values.lenient_int_via_float(F.col("v")).cast("string").alias("v_int"),
        values.lenient_float(F.col("v")).alias("v_float"),
        F.round(values.bytes_to_gb(F.col("k")), 12).alias("k_gb"),
        values.gb_to_bytes(F.round("value", 3)).alias("value_bytes"),
        values.with_unit(F.col("k"), unit).alias("with_unit"),
    )


@query(
    "event_paths",
    """SELECT event_id, coalesce(nullif(json_extract_string(doc, '$.a.b'), ''), nullif(json_extract_string(doc, '$.k'), ''), 'none') AS found
    FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '{"a":{"b":"' || event_type || '"}}' WHEN event_id % 3 = 1 THEN '{"a":{"b":""},"k":"x"}' ELSE props END AS doc FROM events)""",
)
def event_paths(t: Tables) -> DataFrame:
    """First non-empty path of a JSON text."""
    document = (
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit('{"a":{"b":"'), F.col("event_type"), F.lit('"}}')))
        .when(F.col("event_id") % 3 == 1, F.lit('{"a":{"b":""},"k":"x"}'))
        .otherwise(F.col("props"))
    )
    return t.events.select(
        "event_id", F.coalesce(values.first_path(document, "a.b", "k"), F.lit("none")).alias("found")
    )


@query(
    "page_names",
    """SELECT page_id, regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]+)/*$', 1) AS name,
    substr(sha256(url), 1, 16) AS digest FROM pages""",
)
def page_names(t: Tables) -> DataFrame:
    """File names of URLs and their short digests."""
    return t.pages.select(
        "page_id",
        names.url_file_name(F.col("url")).alias("name"),
        identity.short_digest(F.col("url"), 16).alias("digest"),
    )


@query(
    "series_buckets",
    """SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN NULL WHEN length(d) > 3 THEN 'GSE' || left(d, length(d) - 3) || 'nnn' ELSE 'GSEnnn' END AS bucket
    FROM (SELECT doc_id, CAST(doc_id * 37 AS VARCHAR) AS d FROM documents)""",
)
def series_buckets(t: Tables) -> DataFrame:
    """Archive folders of series accessions."""
    accession = F.concat(
        F.when(F.col("doc_id") % 10 == 0, F.lit("GSM")).otherwise(F.lit("gse")), (F.col("doc_id") * 37).cast("string")
    )
    return t.documents.select("doc_id", names.series_bucket(accession).alias("bucket"))


@query(
    "attribute_json",
    """SELECT c_custkey, '{"balance": ' || CASE WHEN c_custkey % 2 = 0 THEN '["' || b || ' USD", "' || c_name || '"]' ELSE '"' || b || ' USD"' END
    || ', "market segment": "' || c_mktsegment || '"}' AS attributes
    FROM (SELECT *, CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) AS b FROM customer)""",
)
def attribute_json(t: Tables) -> DataFrame:
    """Attribute records folded to lists and written as sorted JSON."""

    def record(name: str, value, unit: str | None):
        return F.struct(F.lit(name).alias("name"), value.cast("string").alias("value"), F.lit(unit).cast("string").alias("units"))

    records = F.array_compact(
        F.array(
            record("market segment", F.col("c_mktsegment"), None),
            record("balance", F.floor("c_acctbal"), "USD"),
            F.when(F.col("c_custkey") % 2 == 0, record("balance", F.col("c_name"), None)),
        )
    )
    return t.customer.select(
        "c_custkey", values.sorted_attribute_json(values.fold_attributes(records)).alias("attributes")
    )


@query(
    "submitter_texts",
    """SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN n_name WHEN c_custkey % 4 = 1 THEN c_mktsegment
      ELSE c_mktsegment || ' (' || n_name || ')' END AS submitter
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
)
def submitter_texts(t: Tables) -> DataFrame:
    """Submitter from name, abbreviation and center."""
    joined = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    name = F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    short = F.when(F.col("c_custkey") % 4 == 1, F.col("c_mktsegment")).otherwise(F.col("n_name"))
    return joined.select("c_custkey", values.submitter_text(name, short, F.col("n_name")).alias("submitter"))


@query(
    "experiment_fields",
    """SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'Experiment attribute: ID' WHEN 1 THEN source WHEN 2 THEN 'Experiment attribute: Experiments' ELSE lang END AS field
    FROM documents""",
)
def experiment_fields(t: Tables) -> DataFrame:
    """Field names of experiment attributes."""
    name = (
        F.when(F.col("doc_id") % 4 == 0, F.lit(" ID "))
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("Experimental Factor: "), F.col("source"), F.lit(" ")))
        .when(F.col("doc_id") % 4 == 2, F.lit("Experimental Factor: Experiments"))
        .otherwise(F.col("lang"))
    )
    return t.documents.select("doc_id", experiment_field(name).alias("field"))


@query(
    "execution_names",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS created_at,
    'execution-' || strftime(ts, '%Y%m%dT%H%M%S%f') || 'Z-' || substr(sha256(event_type), 1, 10) AS execution_id FROM events""",
)
def execution_names(t: Tables) -> DataFrame:
    """Execution ids from time stamps and digests."""
    created = values.utc_text(F.col("ts"))
    return t.events.select(
        "event_id",
        created.alias("created_at"),
        identity.execution_name(created, identity.sha256_hex(F.col("event_type"))).alias("execution_id"),
    )


@query(
    "error_lines",
    f"""SELECT doc_id, md5(list_last(list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|\\r|\\n'),
      lambda x: regexp_replace(x, '^{WS}+|{WS}+$', '', 'g')), lambda x: x <> ''))) AS last_line, md5(right(text, 20000)) AS tail FROM documents""",
)
def error_lines(t: Tables) -> DataFrame:
    """Last non-blank line and bounded end of a text."""
    return t.documents.select(
        "doc_id",
        F.md5(text.last_error_line(F.col("text"))).alias("last_line"),
        F.md5(text.bounded_error(F.col("text"))).alias("tail"),
    )


@query(
    "identifier_lookups",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'PRJ' || o_orderkey ELSE 'PRJ' || o_custkey END AS bioproject,
    CAST(NULL AS VARCHAR) AS geo, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) || ',' || CAST(o_custkey AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS pubmed
    FROM orders""",
)
def identifier_lookups(t: Tables) -> DataFrame:
    """Identifiers by namespace and PubMed ids among links."""

    def identifier(namespace, value):
        return F.struct(F.lit("external").alias("kind"), value.cast("string").alias("value"), namespace.alias("namespace"))

    ids = F.array(
        identifier(F.lit("other"), F.col("o_orderkey")),
        identifier(F.when(F.col("o_orderkey") % 2 == 0, F.lit("BioProject")), F.concat(F.lit("PRJ"), F.col("o_orderkey"))),
        identifier(F.lit("bioproject"), F.concat(F.lit("PRJ"), F.col("o_custkey"))),
    )

    def link(database, number):
        return F.struct(database.alias("database"), number.cast("string").alias("id"))

    links = F.array(
        link(F.when(F.col("o_orderkey") % 3 == 0, F.lit("PUBMED")).otherwise(F.lit("gds")), F.col("o_orderkey")),
        link(F.lit("pubmed"), F.col("o_custkey")),
        link(F.lit("pubmed"), F.lit("")),
    )
    return t.orders.select(
        "o_orderkey",
        values.identifier_in(ids, "BioProject").alias("bioproject"),
        values.identifier_in(ids, "GEO").alias("geo"),
        F.array_join(values.pubmed_ids(links), ",").alias("pubmed"),
    )


@query(
    "canonical_identities",
    """SELECT c_custkey, sha256('{"balance":' || CAST(CAST(floor(c_acctbal) AS BIGINT) AS VARCHAR) || ',"name":"' || c_name || '","pin":null,"place":"M\\u00fcnchen \\ud83e\\uddec"}') AS identity FROM customer""",
)
def canonical_identities(t: Tables) -> DataFrame:
    """SHA-256 of canonical JSON in ASCII."""
    return t.customer.select(
        "c_custkey",
        identity.sha256_hex(
            identity.canonical_json(
                name=F.col("c_name"),
                pin=F.lit(None).cast("string"),
                balance=F.floor("c_acctbal"),
                place=F.lit("München 🧬"),
            )
        ).alias("identity"),
    )
