"""Document queries: parse, classify, extract, route and the silver gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import text as text_functions
from tidemark.operators import documents as docs_ops, integrity, profiles
from tidemark.operators.documents import FieldRule
from tidemark.plans import standins
from tidemark.plans.gates import silver_gate
from tidemark.plans.languages import LANGUAGES
from tidemark.session import shared_dir
from tidemark.sources import sinks
from tidemark.sources.tables import table
from tidemark.workload import base
from tidemark.workload.registry import register

# -- contracts -------------------------------------------------------------------
EMAIL = r"([A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,})"
PHONE = r"(\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4})"
ADDRESS = r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})"
CARD = r"(?:^|[ \n])([0-9]{16})(?:[ .,\n]|$)"
VERSION = r"(?i)(?:version|BY-NC) ([0-9]+(?:\.[0-9]+)?)"
TOKEN = r'token = "([0-9a-f]+)"'

NOTE_FIELDS = (
    FieldRule("contact_email", EMAIL, needs="@"), FieldRule("contact_phone", PHONE, needs="+"),
    FieldRule("host_address", ADDRESS), FieldRule("card_number", CARD, "integer"),
    FieldRule("license_version", VERSION, "number"),
)
# The same with a field that is there but is never a number: its rows are errors.
STRICT_FIELDS = (*NOTE_FIELDS, FieldRule("token", TOKEN, "integer", needs="token"))
NOTE_CONTRACTS = {p.label: NOTE_FIELDS for p in LANGUAGES}
STRICT_CONTRACTS = {p.label: STRICT_FIELDS for p in LANGUAGES}

TITLE = r"<title>([^<]*)</title>"
HOST = r"^https?://([^/?#\n]+)"
SECTION = r"^https?://[^/\n]+/([a-z]+)/"
PAGE_NUMBER = r"^https?://[^/\n]+/[a-z]+/([0-9]+)"
LINK = r'href="([^"]+)"'
PAGE_FIELDS = (
    FieldRule("title", TITLE, required=True), FieldRule("host", HOST, required=True),
    FieldRule("section", SECTION), FieldRule("page_number", PAGE_NUMBER, "integer"),
    FieldRule("links", LINK, "list"),
)


def silver_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classified documents; one without evidence gets the most frequent folder."""
    rows = standins.document_rows(spark, sf_dir)
    prior = (integrity.count_by(rows.where("source_class IS NOT NULL"), "source_class")
             .orderBy(F.desc("row_count"), "source_class").first())
    return docs_ops.classify(rows, LANGUAGES, fallback=prior["source_class"] if prior else None)


def _flat(extracted: DataFrame, contracts, keep: list[str]) -> DataFrame:
    """Class structs side by side as one column per field (all classes share the fields)."""
    fields = [rule.name for rule in next(iter(contracts.values()))]
    return extracted.select(*keep, "doc_class", "extract_error", *[
        F.coalesce(*[F.col(f"`{label}`.{name}") for label in contracts]).alias(name)
        for name in fields])


# -- oracle pieces ---------------------------------------------------------------
def _hits(terms) -> str:
    listed = ", ".join(f"'{t}'" for t in terms)
    return f"len(list_filter(tokens, lambda t: list_contains([{listed}], t)))"


_SCORES = ", ".join(f"{_hits(p.terms)} AS s_{p.label}" for p in LANGUAGES)
SILVER = rf"""
scored AS (
  SELECT *, {_SCORES}
  FROM (SELECT doc_id, '/documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
          CAST(doc_id AS VARCHAR) || '.txt' AS filename, lang AS source_class, text AS parsed_text,
          regexp_split_to_array(lower(text), '[^\p{{L}}]+') AS tokens
        FROM documents) AS tokenized),
silver AS (
  SELECT *, CASE WHEN parsed_text IS NULL OR trim(parsed_text) = '' THEN NULL
    WHEN s_de + s_en + s_es + s_fr = 0 THEN (
      SELECT lang FROM documents GROUP BY lang ORDER BY COUNT(*) DESC, lang LIMIT 1)
    WHEN s_de >= s_en AND s_de >= s_es AND s_de >= s_fr THEN 'de'
    WHEN s_en >= s_es AND s_en >= s_fr THEN 'en'
    WHEN s_es >= s_fr THEN 'es' ELSE 'fr' END AS doc_class
  FROM scored)"""


def _first(pattern: str, column: str = "parsed_text") -> str:
    return f"NULLIF(trim(regexp_extract({column}, '{pattern}', 1)), '')"


NOTES = SILVER + f""",
notes AS (
  SELECT path, filename, doc_class, {_first(EMAIL)} AS contact_email, {_first(PHONE)} AS contact_phone,
         {_first(ADDRESS)} AS host_address, TRY_CAST({_first(CARD)} AS BIGINT) AS card_number,
         TRY_CAST({_first(VERSION)} AS DOUBLE) AS license_version, {_first(TOKEN)} AS raw_token,
         {_first(CARD)} AS raw_card, {_first(VERSION)} AS raw_version
  FROM silver),
strict_notes AS (
  SELECT *, TRY_CAST(raw_token AS BIGINT) AS token,
         CASE WHEN raw_token IS NOT NULL AND TRY_CAST(raw_token AS BIGINT) IS NULL
              THEN 'invalid token' END AS extract_error
  FROM notes)"""

# -- bronze ----------------------------------------------------------------------


@register("bronze_docs", """SELECT '/documents/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path,
  CAST(doc_id AS VARCHAR) || '.txt' AS filename, lang AS source_class, strlen(text) AS size_bytes,
  sha256(text) AS digest FROM documents""")
def bronze_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standins.document_rows(spark, sf_dir).select(
        "path", "filename", "source_class",
        F.octet_length("parsed_text").cast("bigint").alias("size_bytes"),
        F.sha2("parsed_text", 256).alias("digest"))


@register("docs_per_class", """SELECT lang AS source_class, COUNT(*) AS row_count
FROM documents GROUP BY lang ORDER BY lang""")
def docs_per_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.count_by(standins.document_rows(spark, sf_dir), "source_class")


@register("class_labels", "SELECT DISTINCT lang AS source_class FROM documents ORDER BY lang")
def class_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.distinct_values(standins.document_rows(spark, sf_dir), "source_class")


# -- parse -----------------------------------------------------------------------
def _replace_all(expr: str, steps) -> str:
    for pattern, replacement in steps:
        expr = f"regexp_replace({expr}, '{pattern}', {replacement}, 'g')"
    return expr


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _decoded_sql(expr: str) -> str:
    """Character references decoded piece by piece, as ``decode_references`` does."""
    names = ", ".join(f"{_quoted(k)}: {_quoted(v)}"
                      for k, v in sorted(text_functions.reference_names().items()))
    point = """CASE WHEN regexp_matches(n, '^#[xX]') THEN CAST('0x' || substr(n, 3) AS BIGINT)
      WHEN n LIKE '#%' THEN CAST(substr(n, 2) AS BIGINT) END"""
    char = f"""coalesce(MAP {{{names}}}[CASE WHEN n LIKE '#%' THEN '#' || CAST(({point}) AS VARCHAR) ELSE n END],
      CASE WHEN ({point}) BETWEEN 1 AND 1114111 AND NOT ({point}) BETWEEN 55296 AND 57343
           THEN chr(CAST(({point}) AS INTEGER)) WHEN ({point}) IS NOT NULL THEN chr(65533) END)"""
    piece = f"list_transform([regexp_extract(p, '{text_functions.REFERENCE}', 1)], lambda n: " \
            f"coalesce({char} || substr(p, length(n) + 2), '&' || p))[1]"
    return f"""list_transform(string_split({expr}, '&'), lambda p, i:
      CASE WHEN i = 1 THEN p ELSE {piece} END)"""


def _parsed_sql(pages: str = "pages") -> str:
    hidden = _replace_all("html", [(p, "' '") for p in text_functions.HIDDEN_BLOCKS])
    blocks = _replace_all(hidden, [(text_functions.BLOCK_TAG, "chr(10)"),
                                   (text_functions.ANY_TAG, "''")])
    text = _replace_all(f"array_to_string({_decoded_sql(blocks)}, '')",
                        [(text_functions.BLANKS, "' '")])
    return f"""
parsed AS (
  SELECT page_id, list_filter(list_transform(string_split({text}, chr(10)), lambda b: trim(b, ' ')),
                              lambda b: b <> '') AS elements
  FROM {pages})"""


PARSED = _parsed_sql()


@register("parse_pages", base.with_ctes(
    """SELECT page_id, len(elements) AS element_count, array_to_string(elements, chr(10)) AS parsed_text
FROM parsed WHERE len(elements) > 0""", PARSED))
def parse_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = docs_ops.parse_html(table(spark, sf_dir, "pages"))
    return docs_ops.drop_failures(parsed).select(
        "page_id", F.size("parsed.document.elements").cast("bigint").alias("element_count"),
        docs_ops.parsed_text().alias("parsed_text"))


@register("parse_errors", base.with_ctes(
    """SELECT COALESCE(status, 'parsed') AS outcome, COUNT(*) AS page_count
FROM (SELECT p.page_id, CASE WHEN h.html IS NULL OR trim(h.html) = '' THEN 'no content'
             WHEN len(p.elements) = 0 THEN 'no text' END AS status
      FROM parsed p JOIN pages h ON p.page_id = h.page_id) AS judged GROUP BY 1""", PARSED))
def parse_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = docs_ops.parse_html(table(spark, sf_dir, "pages"))
    return parsed.groupBy(F.coalesce("parsed.error_status", F.lit("parsed")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("page_count"))


# Pages as other software writes them: references by name, number and hexadecimal number, ones
# that are no reference, an ampersand that is written out; and pages with nothing to read.
_WRITTEN = ((" et ", " &eacute;t&#233; &#8217;&#xE9;&laquo;&#x1F600;&nbsp;"), (" de ", " &amp;lt; &#150;&#xD800; "),
            (" in ", " &bogus; &copy2; & &amp;&euro "), (" und ", " &#0;&#1114112;&hellip;&zwj; "))
_EMPTY, _BLANK, _ABSENT = ".example.org/de/", ".example.org/en/", ".example.org/fr/"


def written_pages(pages: DataFrame) -> DataFrame:
    html, url = F.col("html"), F.col("url")
    for word, written in _WRITTEN:
        html = F.replace(html, F.lit(word), F.lit(written))
    return pages.select("page_id", F.when(url.contains(_EMPTY), F.lit("")).when(
        url.contains(_BLANK), F.lit("<p> </p><!-- -->")).when(
        url.contains(_ABSENT), F.lit(None)).otherwise(html).alias("html"))


def _written_sql() -> str:
    html = "html"
    for word, written in _WRITTEN:
        html = f"replace({html}, '{word}', '{written}')"
    return f"""
written AS (
  SELECT page_id, CASE WHEN contains(url, '{_EMPTY}') THEN '' WHEN contains(url, '{_BLANK}')
    THEN '<p> </p><!-- -->' WHEN contains(url, '{_ABSENT}') THEN NULL ELSE {html} END AS html
  FROM pages),{_parsed_sql("written")}"""


@register("parse_written_pages", base.with_ctes(
    """SELECT w.page_id, CASE WHEN w.html IS NULL OR trim(w.html) = '' THEN 'no content'
    WHEN len(p.elements) = 0 THEN 'no text' END AS outcome,
  COALESCE(array_to_string(p.elements, chr(10)), '') AS parsed_text
FROM written w JOIN parsed p ON p.page_id = w.page_id""", _written_sql()))
def parse_written_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with references of every kind, and some that are empty, blank or absent."""
    parsed = docs_ops.parse_html(written_pages(table(spark, sf_dir, "pages")))
    return parsed.select("page_id", F.col("parsed.error_status").alias("outcome"),
                         docs_ops.parsed_text().alias("parsed_text"))


@register("variant_fields", """SELECT event_id, CAST(props->>'k' AS BIGINT) AS k,
  (props->>'missing') IS NULL AS absent FROM events""")
def variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi-structured values by path; a missing path is NULL."""
    props = table(spark, sf_dir, "events").select(
        "event_id", F.try_parse_json("props").alias("props"))
    return props.select(
        "event_id", F.try_variant_get("props", "$.k", "bigint").alias("k"),
        F.try_variant_get("props", "$.missing", "string").isNull().alias("absent"))


@register("parse_variant", base.with_ctes(
    """SELECT page_id, array_to_string(elements, chr(10)) AS parsed_text, TRUE AS clean
FROM parsed WHERE len(elements) > 0""", PARSED))
def parse_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parse result kept as VARIANT: a JSON null status counts as no error."""
    parsed = docs_ops.parse_html(table(spark, sf_dir, "pages"))
    kept = docs_ops.drop_failures(parsed).select("page_id", F.to_variant_object("parsed").alias("parsed"))
    return kept.select("page_id", docs_ops.variant_text().alias("parsed_text"),
                       docs_ops.variant_error().isNull().alias("clean"))


# -- classify --------------------------------------------------------------------
LEARNED = rf"""
labelled AS (
  SELECT doc_id, lang AS label, text,
         list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}]+'), lambda t: t <> '') AS words
  FROM documents WHERE text IS NOT NULL AND trim(text) <> ''),
counts AS (
  SELECT label, term, COUNT(*) AS docs
  FROM (SELECT label, unnest(list_distinct(words)) AS term FROM labelled WHERE label IS NOT NULL)
  GROUP BY label, term),
sizes AS (SELECT label, COUNT(*) AS size, SUM(COUNT(*)) OVER () AS total
          FROM labelled WHERE label IS NOT NULL GROUP BY label),
rated AS (
  SELECT label, term, docs, (SELECT COUNT(*) FROM range(1, {profiles.MOST + 1}) AS steps(i)
    WHERE inside >= outside * pow(2.0, i)) AS weight
  FROM (SELECT c.label, c.term, c.docs, CAST(docs + 1 AS DOUBLE) * (total - size + 2) AS inside,
          CAST(SUM(docs) OVER (PARTITION BY c.term) - docs + 1 AS DOUBLE) * (size + 2) AS outside
        FROM counts c JOIN sizes s ON s.label = c.label) AS odds),
profiles AS (
  SELECT label, term, weight FROM rated WHERE weight > 0
  QUALIFY row_number() OVER (PARTITION BY label ORDER BY docs * weight DESC, term) <= {profiles.TERMS}),
scores AS (
  SELECT w.doc_id, p.label, SUM(p.weight) AS score
  FROM (SELECT doc_id, unnest(words) AS term FROM labelled) w JOIN profiles p ON p.term = w.term
  GROUP BY w.doc_id, p.label),
predicted AS (
  SELECT d.doc_id, d.lang AS source_class, CASE WHEN d.text IS NULL OR trim(d.text) = '' THEN NULL
    ELSE coalesce(b.label, (SELECT lang FROM documents WHERE lang IS NOT NULL
                            GROUP BY lang ORDER BY COUNT(*) DESC, lang LIMIT 1)) END AS doc_class
  FROM documents d LEFT JOIN (
    SELECT * FROM scores
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) = 1) b
    ON b.doc_id = d.doc_id)"""


def learned_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiles.learn_profiles(standins.document_rows(spark, sf_dir))


def predicted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents classified by profiles learned from the folders they were shipped in."""
    rows = standins.document_rows(spark, sf_dir)
    return docs_ops.classify(rows, profiles.collected(learned_profiles(spark, sf_dir)),
                             fallback=profiles.most_frequent(rows))


@register("class_profiles", base.with_ctes("SELECT label, term, weight FROM profiles", LEARNED))
def class_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The terms that tell the folders apart, with their weights."""
    return learned_profiles(spark, sf_dir)


@register("classify_docs", base.with_ctes("SELECT doc_id, doc_class FROM predicted", LEARNED))
def classify_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted_documents(spark, sf_dir).select("doc_id", "doc_class")


@register("class_confusion", base.with_ctes(
    """SELECT source_class, doc_class, COUNT(*) AS row_count FROM predicted
GROUP BY source_class, doc_class ORDER BY source_class, doc_class""", LEARNED))
def class_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.count_by(predicted_documents(spark, sf_dir), "source_class", "doc_class")


@register("allowed_values", base.with_ctes(
    """SELECT source AS value, COUNT(*) AS row_count FROM documents
WHERE source IS NOT NULL AND source NOT IN (SELECT 'src' || CAST(n_regionkey AS VARCHAR) FROM nation)
GROUP BY source""", "one AS (SELECT 1 AS x)"))
def allowed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources outside an allowed list taken from another table."""
    allowed = table(spark, sf_dir, "nation").select(
        F.concat(F.lit("src"), F.col("n_regionkey").cast("string")).alias("label"))
    return integrity.unexpected_values(table(spark, sf_dir, "documents"), "source", allowed, "label")


@register("stray_labels", base.with_ctes(
    """SELECT COUNT(*) AS stray_rows FROM silver
WHERE doc_class IS NOT NULL AND doc_class NOT IN (SELECT lang FROM documents)""", SILVER))
def stray_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver = silver_documents(spark, sf_dir)
    return integrity.unexpected_values(
        silver, "doc_class", standins.document_rows(spark, sf_dir), "source_class"
    ).agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("stray_rows"))


@register("doc_integrity", base.with_ctes(
    """SELECT COUNT(*) AS total_rows,
  COUNT(*) FILTER (WHERE parsed_text IS NULL OR trim(parsed_text) = '') AS blank_text,
  COUNT(*) FILTER (WHERE doc_class IS NULL) AS null_class,
  COUNT(DISTINCT source_class || '/' || filename) AS distinct_documents FROM silver""", SILVER))
def doc_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.document_integrity(silver_documents(spark, sf_dir))


@register("route_by_class", base.with_ctes(
    """SELECT l.label, COUNT(s.doc_id) AS routed_rows
FROM (SELECT DISTINCT lang AS label FROM documents UNION SELECT 'src' FROM documents) l
LEFT JOIN silver s ON s.doc_class = l.label GROUP BY l.label""", SILVER))
def route_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class; the class ``src`` has no documents and still gets its row."""
    labels = table(spark, sf_dir, "documents").select(F.col("lang").alias("label")).union(
        table(spark, sf_dir, "documents").select(F.regexp_replace("source", "[0-9]+", "")))
    return docs_ops.route_counts(silver_documents(spark, sf_dir), labels)


# -- extract ---------------------------------------------------------------------
@register("extract_fields", base.with_ctes(
    f"""SELECT page_id, doc_class, CASE WHEN title IS NULL AND host IS NULL THEN 'missing title; missing host'
  WHEN title IS NULL THEN 'missing title' WHEN host IS NULL THEN 'missing host' END AS extract_error,
  title, host, section, TRY_CAST(raw_number AS BIGINT) AS page_number, links
FROM (SELECT page_id, {_first('<html lang="([a-z]+)"', 'body')} AS doc_class,
        {_first(TITLE, 'body')} AS title, {_first(HOST, 'body')} AS host,
        {_first(SECTION, 'body')} AS section, {_first(PAGE_NUMBER, 'body')} AS raw_number,
        array_to_string(regexp_extract_all(body, '{LINK}', 1), ' ') AS links
      FROM (SELECT page_id, url || chr(10) || html AS body FROM pages) AS bodies) AS found""",
    "one AS (SELECT 1 AS x)"))
def extract_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    contracts = {p.label: PAGE_FIELDS for p in LANGUAGES}
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.concat_ws("\n", "url", "html").alias("body"),
        text_functions.first_match("html", r'<html lang="([a-z]+)"').alias("doc_class"))
    extracted = docs_ops.extract(pages, contracts, "body", keep=("page_id",))
    return _flat(extracted, contracts, ["page_id"]).withColumn(
        "links", F.coalesce(F.array_join("links", " "), F.lit("")))


@register("typed_extract", base.with_ctes(
    """SELECT path, filename, doc_class, extract_error, contact_email, contact_phone, host_address,
  card_number, license_version, token FROM strict_notes""", NOTES))
def typed_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    extracted = docs_ops.extract(silver_documents(spark, sf_dir), STRICT_CONTRACTS)
    return _flat(extracted, STRICT_CONTRACTS, ["path", "filename"])


@register("extract_integrity", base.with_ctes(
    """SELECT doc_class, COUNT(*) AS total_rows, COUNT(extract_error) AS error_rows,
  COUNT(DISTINCT path) AS distinct_paths FROM strict_notes GROUP BY doc_class
UNION ALL
SELECT '(all)', COUNT(*), COUNT(extract_error), COUNT(DISTINCT path) FROM strict_notes""", NOTES))
def extract_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.extract_integrity(
        docs_ops.extract(silver_documents(spark, sf_dir), STRICT_CONTRACTS))


def _silver_gate(spark: SparkSession, sf_dir: str, contracts, name: str) -> DataFrame:
    """Silver and class tables are written once; the gate reads what was written."""
    root = shared_dir(spark, name)
    silver = sinks.materialize(silver_documents(spark, sf_dir), f"{root}/silver")
    shipped = standins.document_rows(spark, sf_dir)
    labels = [r[0] for r in integrity.distinct_values(shipped, "source_class").collect()]
    docs_ops.write_class_tables(docs_ops.extract(silver, contracts), f"{root}/classes", labels)
    return silver_gate(silver, shipped, spark.read.parquet(f"{root}/classes"),
                       docs_ops.class_tables_written(spark, f"{root}/classes", labels))


def _silver_gate_sql(errors: str) -> str:
    return base.gate_sql([
        ("expected", "n > 0", "n", "1"), ("text", "blank = 0", "blank", "0"),
        ("class", "unclassified = 0", "unclassified", "0"), ("duplicates", "k = n", "k", "n"),
        ("identity", "k = n", "n - k", "0"), ("labels", "stray = 0", "stray", "0"),
        ("class_tables", "labels > 0", "labels", "labels"),
        ("extract_errors", "errors = 0", "errors", "0"),
        ("extract_duplicates", "k = n", "k", "n"), ("extract_total", "n > 0", "n", "n"),
    ], f"""{NOTES},
m AS (SELECT (SELECT COUNT(*) FROM silver) AS n,
  (SELECT COUNT(DISTINCT path) FROM silver) AS k,
  (SELECT COUNT(DISTINCT lang) FROM documents) AS labels,
  (SELECT COUNT(*) FROM silver WHERE trim(parsed_text) = '') AS blank,
  (SELECT COUNT(*) FROM silver WHERE doc_class IS NULL) AS unclassified,
  (SELECT COUNT(DISTINCT doc_class) FROM silver
   WHERE doc_class NOT IN (SELECT lang FROM documents)) AS stray,
  (SELECT {errors} FROM strict_notes) AS errors)""")


@register("gate_silver", _silver_gate_sql("""COUNT(*) FILTER (
    WHERE (raw_card IS NOT NULL AND card_number IS NULL)
    OR (raw_version IS NOT NULL AND license_version IS NULL))"""))
def gate_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_gate(spark, sf_dir, NOTE_CONTRACTS, "silver")


@register("gate_silver_strict", _silver_gate_sql("COUNT(extract_error)"))
def gate_silver_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate stops at the extraction errors of the strict contract."""
    return _silver_gate(spark, sf_dir, STRICT_CONTRACTS, "silver-strict")
