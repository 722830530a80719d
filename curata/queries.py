"""The registered queries of the record engine, and the DuckDB SQL of each.

A query is a function of (spark, sf_dir) over whole tables. Counts and positions are bigint on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from curata.functions import fields, identity, json_text, nested, redact, text
from curata.operators import audit, media, report, sampling, transform, validate
from curata.operators.storage import shared_dir
from curata.sinks import writers
from curata.sources import readers
from curata.streaming import resumable

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def register(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("bigint")


def row_of(**values: Column) -> Column:
    return F.create_map(*(x for k, v in values.items() for x in (F.lit(k), v.cast("string"))))


# ---------------------------------------------------------------- fields and names


@query("""
SELECT d.doc_id, coalesce(nullif(CASE WHEN d.lang = 'en' THEN '' ELSE d.lang END, ''), nullif(d.source, ''), 'none') AS name,
  coalesce(CAST(l.quality AS VARCHAR), 'unlabelled') AS quality
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def field_coalesce(spark, sf_dir):
    """A value of several columns by priority; "" is missing, 0 is not."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("lang") == "en", "").otherwise(F.col("lang")).alias("lang"), "source")
    joined = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return joined.select("doc_id", fields.first_present("lang", "source", F.lit("none")).alias("name"), fields.first_present(F.col("quality").cast("string"), F.lit("unlabelled")).alias("quality"))


@query("""
SELECT n_nationkey, CASE WHEN n_regionkey = 0 THEN 'Prompt' WHEN n_regionkey = 1 THEN 'query' ELSE 'QUESTION' END AS key,
  CASE WHEN n_regionkey = 0 THEN 'r0' ELSE n_name END AS value FROM nation""")
def field_lookup_case(spark, sf_dir):
    """Keys in any case: exact names first, over all of them, before the others."""
    region = F.col("n_regionkey")
    row = row_of(
        QUESTION=F.when(region > 1, F.col("n_name")).otherwise(""), query=F.when(region == 1, F.col("n_name")).otherwise(""),
        Prompt=F.when(region == 0, F.lit("r0")).otherwise(""),
    )
    found = table(spark, sf_dir, "nation").select("n_nationkey", fields.get_first(row, ("question", "query", "Query", "prompt")).alias("f"))
    return found.select("n_nationkey", "f.key", "f.value")


_SPLIT_INPUT = "CASE lang WHEN 'en' THEN 'Val' WHEN 'de' THEN ' dev ' WHEN 'fr' THEN '' WHEN 'es' THEN '--' ELSE source || '/X y' END"


@query(f"""
WITH s AS (SELECT doc_id, source, {_SPLIT_INPUT} AS raw FROM documents),
n AS (SELECT doc_id, source, coalesce(nullif(lower(trim(regexp_replace(coalesce(nullif(trim(coalesce(nullif(raw, ''), 'Train 1')), ''), 'Train 1'), '[^A-Za-z0-9_]+', '_', 'g'), '_')), ''), 'test') AS split FROM s)
SELECT doc_id, split, CASE WHEN split IN ('val', 'valid', 'dev') THEN 'validation' ELSE split END AS package_split, lower(regexp_replace(source, '[^A-Za-z0-9_]+', '_', 'g')) AS source_split FROM n""")
def split_normalize(spark, sf_dir):
    """Split names: normal form, default, and the package's names."""
    raw = F.expr(_SPLIT_INPUT)
    split = identity.normal_split(raw, "Train 1")
    return table(spark, sf_dir, "documents").select("doc_id", split.alias("split"), identity.package_split(split).alias("package_split"), identity.normal_split(F.col("source")).alias("source_split"))


_SECRET_SQL = r"""regexp_replace(regexp_replace(regexp_replace({t}, '(Authorization\s*[:=]\s*Bearer\s+)([^\s"'']+)', '\1<redacted>', 'gi'),
  '\bsk-[A-Za-z0-9_-]{{10,}}\b', 'sk-<redacted>', 'g'),
  '(["'']?\b(?:(?:[A-Za-z0-9]+_)*token|access_token|api_key|client_secret|id_token|jupyter_token|oauth_token|password|passwd|pwd|refresh_token|secret)\b["'']?\s*[=:]\s*["'']?)([^\s,;"''}}]+)', '\1<redacted>', 'gi')"""


@query(f"""
WITH c AS (SELECT conv_id, turn, lower(regexp_replace(role, '[^A-Za-z0-9_]+', '_', 'g')) AS split, coalesce(text, '') AS text FROM conversations)
SELECT 'conversations/' || split || '/' || conv_id || '#turn-' || turn AS record_id, conv_id || '#turn-' || turn AS source_id, split,
  sha256({_SECRET_SQL.format(t="text")}) AS text_sha256, CAST(length(text) AS BIGINT) AS n_chars FROM c""")
def record_ids(spark, sf_dir):
    """Flagship: source id with its turn, normal split, record id, redacted text."""
    said = F.coalesce("text", F.lit(""))
    split = identity.normal_split(F.col("role"))
    source = identity.source_id(F.col("conv_id").cast("string"), [], F.col("turn"), identity.stable_hash(said))
    return table(spark, sf_dir, "conversations").select(
        identity.record_id(F.lit("conversations"), split, source).alias("record_id"), source.alias("source_id"), split.alias("split"),
        F.sha2(redact.redact_text(said), 256).alias("text_sha256"), big(F.length(said)).alias("n_chars"),
    )


@query("""
SELECT doc_id, substr(sha256(coalesce(text, '')), 1, 12) AS text_hash,
  substr(sha256(length(lang) || ':' || lang || length(source) || ':' || source || length(CAST(n_chars AS VARCHAR)) || ':' || n_chars), 1, 8) AS row_hash
FROM documents""")
def content_hash(spark, sf_dir):
    """Stable hashes of one value and of several."""
    return table(spark, sf_dir, "documents").select("doc_id", identity.stable_hash("text").alias("text_hash"), identity.stable_hash("lang", "source", "n_chars", length=8).alias("row_hash"))


@query(r"""
SELECT 'part' AS kind, CAST(p_partkey AS BIGINT) AS id, coalesce(nullif(lower(trim(regexp_replace(p_name, '[^A-Za-z0-9_]+', '_', 'g'), '_')), ''), 'input') AS label,
  coalesce(nullif(trim(regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g'), '._-'), ''), 'item') AS part FROM part
UNION ALL SELECT 'page', page_id, coalesce(nullif(lower(trim(regexp_replace(url, '[^A-Za-z0-9_]+', '_', 'g'), '_')), ''), 'input'),
  coalesce(nullif(trim(regexp_replace(url, '[^\p{L}\p{N}._-]+', '_', 'g'), '._-'), ''), 'item') FROM pages""")
def safe_labels(spark, sf_dir):
    """Names that are safe in paths."""
    named = lambda t, kind, key, name: table(spark, sf_dir, t).select(F.lit(kind).alias("kind"), big(key).alias("id"), identity.safe_label(F.col(name)).alias("label"), identity.safe_part(F.col(name)).alias("part"))
    return named("part", "part", "p_partkey", "p_name").unionByName(named("pages", "page", "page_id", "url"))


_REFS_SQL = "CASE page_id % 4 WHEN 0 THEN url WHEN 1 THEN 'img/p ' || page_id || '.PNG?x=1' WHEN 2 THEN 'photo ' || page_id || '.jpeg' ELSE 'no path ' || page_id END"


@query(f"""
WITH r AS (SELECT page_id, {_REFS_SQL} AS ref FROM pages)
SELECT page_id, regexp_matches(lower(regexp_replace(trim(ref), '\\?.*$', '')), '\\.(jpg|jpeg|png|bmp|gif|webp|tif|tiff)$') OR (contains(trim(ref), '/') AND NOT contains(trim(ref), ' ')) AS path_like,
  regexp_matches(lower(ref), '\\.(jpg|jpeg|png|bmp|gif|webp|tif|tiff)$') AS image_file FROM r""".replace("\\\\", "\\"))
def path_like(spark, sf_dir):
    """What looks like a path, and what is an image file."""
    ref = F.expr(_REFS_SQL)
    return table(spark, sf_dir, "pages").select("page_id", text.looks_path_like(ref).alias("path_like"), text.is_image_file(ref).alias("image_file"))


@query("""
SELECT 'order' AS kind, o_orderstatus AS value, regexp_matches(trim(o_orderstatus), '(?i)^(?:[A-Z]|[0-9]+|true|false|yes|no)$') AS label_like, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY ALL
UNION ALL SELECT 'flag', l_returnflag || l_linestatus, regexp_matches(trim(l_returnflag || l_linestatus), '(?i)^(?:[A-Z]|[0-9]+|true|false|yes|no)$'), CAST(count(*) AS BIGINT) FROM lineitem GROUP BY ALL
UNION ALL SELECT 'size', CAST(p_size AS VARCHAR), true, CAST(count(*) AS BIGINT) FROM part GROUP BY ALL""")
def label_like(spark, sf_dir):
    """What is a label and not a text."""
    counted = lambda t, kind, v: table(spark, sf_dir, t).select(F.lit(kind).alias("kind"), v.cast("string").alias("value")).groupBy("kind", "value").agg(F.count("*").alias("n"))
    rows = counted("orders", "order", F.col("o_orderstatus")).unionByName(counted("lineitem", "flag", F.concat("l_returnflag", "l_linestatus"))).unionByName(counted("part", "size", F.col("p_size")))
    return rows.select("kind", "value", text.looks_label_like(F.col("value")).alias("label_like"), "n")


@query("""
SELECT p_partkey, concat_ws(',', CASE WHEN regexp_matches(p_brand, '[A-Za-z]') THEN 'brand' END, CASE WHEN regexp_matches(p_name, '[A-Za-z]') THEN 'name' END) AS textual FROM part""")
def textual_fields(spark, sf_dir):
    """Fields of a row that hold text: numbers, paths and labels don't."""
    values = {"brand": F.col("p_brand"), "name": F.col("p_name"), "path": F.concat(F.lit("img/"), F.col("p_type"), F.lit(".png")), "size": F.col("p_size").cast("string")}
    found = F.array(*(F.when(text.looks_textual(nested.text_leaves(v)), F.lit(k)) for k, v in values.items()))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_compact(found), ",").alias("textual"))


_ALIASES = {"automobile": "auto", "house_hold": "household", "machinery": "machines"}


@query("""
SELECT c_custkey, CASE lower(c_mktsegment) WHEN 'automobile' THEN 'auto' WHEN 'machinery' THEN 'machines' ELSE lower(c_mktsegment) END AS id,
  CASE lower(c_mktsegment) WHEN 'automobile' THEN 'auto' WHEN 'machinery' THEN 'machines' ELSE lower(c_mktsegment) END || '|household' AS ids FROM customer""")
def alias_ids(spark, sf_dir):
    """Ids under other names, alone and in lists."""
    seg = F.col("c_mktsegment")
    return table(spark, sf_dir, "customer").select("c_custkey", identity.alias_id(seg, _ALIASES).alias("id"), F.array_join(identity.parse_ids(F.concat(F.lit(" "), seg, F.lit(",, House Hold")), _ALIASES), "|").alias("ids"))


# ---------------------------------------------------------------- nested values


def _documents_of(spark, sf_dir) -> DataFrame:
    turns = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    grouped = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turns.alias("conversation"))
    return grouped.select("conv_id", F.to_json(F.struct(F.lit("all").alias("role"), F.lit("t").alias("title"), "conversation")).alias("document"))


@query("""
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS BIGINT) AS conversation_index, role, 't' AS title, sha256(coalesce(text, '')) AS text_sha256 FROM conversations""")
def flatten_conversations(spark, sf_dir):
    """Nested documents back to one row a turn; a turn's keys override the document's."""
    flat = nested.flatten_conversations(_documents_of(spark, sf_dir), "conv_id", "document")
    r = F.col("row")
    return flat.select("conv_id", "conversation_index", r["role"].alias("role"), r["title"].alias("title"), F.sha2(F.coalesce(r["text"], F.lit("")), 256).alias("text_sha256"))


@query("""
WITH c AS (SELECT conv_id, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT CAST(count(*) AS BIGINT) AS n_conversations, CAST(sum(n) AS BIGINT) AS n_turns, CAST(min(n) AS BIGINT) AS least, CAST(max(n) AS BIGINT) AS most FROM c""")
def conversation_stats(spark, sf_dir):
    """Turns a conversation: count, total, least, most."""
    n = report.group_sizes(table(spark, sf_dir, "conversations"), "conv_id")
    return n.select(F.col("groups").alias("n_conversations"), F.col("rows").alias("n_turns"), "least", "most")


@query("SELECT conv_id, sha256(arg_max(text, turn)) AS text_sha256 FROM conversations WHERE role = 'user' AND text <> '' GROUP BY conv_id")
def final_user_text(spark, sf_dir):
    """The last text of the user in each conversation."""
    last = nested.last_user_text(F.col("turn"), F.col("role"), F.col("text"))
    own = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(last.alias("last"))
    return own.where("last is not null").select("conv_id", F.sha2("last", 256).alias("text_sha256"))


@query("""
WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[1, 2, "a"]' WHEN 2 THEN '{"a": 1, "b": 2}' ELSE 'no json' END AS j FROM events)
SELECT event_id, CAST(CASE WHEN NOT json_valid(j) THEN NULL WHEN json_type(j) = 'ARRAY' THEN json_array_length(j) WHEN json_type(j) = 'OBJECT' THEN len(json_keys(j)) END AS BIGINT) AS n_options FROM e""")
def json_option_count(spark, sf_dir):
    """Options in JSON text: of a list, of an object, none elsewhere."""
    j = F.expr("""CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN '[1, 2, "a"]' WHEN 2 THEN '{"a": 1, "b": 2}' ELSE 'no json' END""")
    return table(spark, sf_dir, "events").select("event_id", nested.json_option_count(j).alias("n_options"))


@query(r"""
WITH l AS (SELECT doc_id, list_filter(string_split(text, chr(10)), lambda x: trim(x) <> '') AS l FROM documents),
o AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN list_transform(l, lambda x, i: i || '. ' || x) ELSE l END AS l FROM l)
SELECT doc_id, CAST(CASE WHEN len(l) > 1 AND len(list_filter(l, lambda x: NOT regexp_matches(x, '^\s*([A-Z]|[0-9]+)[.):]\s*') AND NOT regexp_matches(x, '^\s*\([A-Z0-9]+\)\s*'))) = 0 THEN len(l) END AS BIGINT) AS n_options FROM o""")
def line_option_count(spark, sf_dir):
    """Options in lines: counted only if there are several and all have a label."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.trim(x) != "")
    labelled = F.transform(lines, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x))
    return table(spark, sf_dir, "documents").select("doc_id", text.option_count(F.array_join(F.when(F.col("doc_id") % 2 == 0, labelled).otherwise(lines), "\n")).alias("n_options"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN 'brand,note,title' ELSE 'brand,title' END AS text_fields FROM part")
def text_field_discovery(spark, sf_dir):
    """Keys of a row that hold text and aren't structural, whatever their case."""
    row = row_of(
        title=F.col("p_name"), brand=F.col("p_brand"), Category=F.col("p_type"), size=F.col("p_size"), link=F.concat(F.lit("a/"), F.col("p_type")),
        note=F.when(F.col("p_size") % 2 == 0, F.lit("see below")).otherwise("yes"),
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(nested.discover_text_fields(row), ",").alias("text_fields"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL ELSE props END AS payload FROM events")
def json_payload_extract(spark, sf_dir):
    """JSON out of an answer: fenced, bare, or with words around it."""
    p = F.col("props")
    k = F.col("event_id") % 4
    said = F.when(k == 0, F.concat(F.lit("```json\n"), p, F.lit("\n```"))).when(k == 1, p).when(k == 2, F.concat(F.lit("Here: "), p, F.lit(" - done"))).otherwise("nothing {here")
    return table(spark, sf_dir, "events").select("event_id", nested.json_payload(said).alias("payload"))


@query("SELECT conv_id, CAST(count(*) AS BIGINT) AS n_leaves, sha256(string_agg(text, chr(10) ORDER BY turn, text)) AS text_sha256 FROM conversations WHERE trim(text) <> '' GROUP BY conv_id")
def join_leaves(spark, sf_dir):
    """Text leaves of a nested value, joined."""
    leaves = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda t: t["text"])
    own = table(spark, sf_dir, "conversations").where(text.trimmed(F.col("text")) != "").groupBy("conv_id").agg(leaves.alias("leaves"))
    return own.select("conv_id", big(F.size("leaves")).alias("n_leaves"), F.sha2(nested.joined_text(F.col("leaves")), 256).alias("text_sha256"))


# ---------------------------------------------------------------- redaction


@query(f"""
WITH r AS (SELECT doc_id, coalesce(text, '') AS text, {_SECRET_SQL.format(t="coalesce(text, '')")} AS clean FROM documents)
SELECT doc_id, text <> clean AS redacted, sha256(clean) AS clean_sha256 FROM r""")
def redact_secrets(spark, sf_dir):
    """Texts without secret-looking values."""
    said = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select("doc_id", said.alias("text"), redact.redact_text(said).alias("clean"))
    return rows.select("doc_id", (F.col("text") != F.col("clean")).alias("redacted"), F.sha2("clean", 256).alias("clean_sha256"))


@query(f"""
WITH r AS (SELECT doc_id, lang, coalesce(text, '') AS text, {_SECRET_SQL.format(t="coalesce(text, '')")} AS clean FROM documents)
SELECT lang, path, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT lang, '$.text' AS path FROM r WHERE text <> clean UNION ALL SELECT lang, '$.extra[0].api_key' FROM r WHERE doc_id % 10 = 0 UNION ALL SELECT lang, '$.my_token' FROM r) GROUP BY ALL""")
def secret_findings(spark, sf_dir):
    """Paths of secret-looking leaves of nested rows; a zero under a secret name is found too."""
    key = F.when(F.col("doc_id") % 10 == 0, "k").otherwise(redact.REDACTED)
    rows = table(spark, sf_dir, "documents").select("lang", "text", F.array(F.struct(key.alias("api_key"), F.lit(5).alias("max_tokens"))).alias("extra"), F.lit(0).alias("my_token"))
    found = F.concat(*(redact.findings(F.col(f.name), f.dataType, f"$.{f.name}", f.name) for f in rows.schema if f.name != "lang"))
    return rows.select("lang", F.explode(found).alias("path")).groupBy("lang", "path").agg(F.count("*").alias("n"))


# ---------------------------------------------------------------- coverage, samples, duplicates


@query("SELECT d.doc_id FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_anti_join(spark, sf_dir):
    """What is left to do: accepted and failed rows are both done."""
    labels = table(spark, sf_dir, "labels")
    done = audit.done_keys(labels.where("quality = 1"), labels.where("quality = 0"), "doc_id")
    return audit.pending(table(spark, sf_dir, "documents").select("doc_id"), done, "doc_id")


@query("""
WITH a AS (SELECT DISTINCT c_nationkey % 20 AS k FROM customer), b AS (SELECT DISTINCT s_nationkey + 3 AS k FROM supplier)
SELECT k, 'missing' AS status FROM (SELECT k FROM a EXCEPT SELECT k FROM b) UNION ALL SELECT k, 'unexpected' FROM (SELECT k FROM b EXCEPT SELECT k FROM a)""")
def coverage_diff(spark, sf_dir):
    """Expected and found keys, both ways."""
    expected = table(spark, sf_dir, "customer").select((F.col("c_nationkey") % 20).alias("k"))
    return audit.coverage(expected, table(spark, sf_dir, "supplier").select((F.col("s_nationkey") + 3).alias("k")), "k")


@query("""
WITH a AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 0 GROUP BY 1), b AS (SELECT c_nationkey AS k, count(*) AS n FROM customer WHERE c_acctbal > 100 AND c_nationkey <> 3 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CAST(coalesce(a.n, 0) AS BIGINT) AS left_n, CAST(coalesce(b.n, 0) AS BIGINT) AS right_n FROM a FULL JOIN b ON a.k = b.k WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def count_reconcile(spark, sf_dir):
    """Counts of two sides, where they differ."""
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k"), "c_acctbal")
    counts = lambda df: df.groupBy("k").agg(F.count("*").alias("n"))
    return audit.reconcile(counts(c.where("c_acctbal > 0")), counts(c.where("c_acctbal > 100 and k <> 3")), "k")


@query("""
SELECT n.n_nationkey, s.status FROM nation n, (VALUES ('F'), ('O'), ('P'), ('X')) s(status)
WHERE (n.n_nationkey, s.status) NOT IN (SELECT c_nationkey, o_orderstatus FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 498000)""")
def required_bundle(spark, sf_dir):
    """Parts that each owner must have and hasn't."""
    there = table(spark, sf_dir, "orders").where("o_totalprice > 498000").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("n_nationkey"), F.col("o_orderstatus").alias("status"))
    return audit.required(table(spark, sf_dir, "nation"), ["F", "O", "P", "X"], there, "n_nationkey", "status")


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'k' WHEN event_id % 3 = 1 THEN 'token,z' ELSE '' END AS unexpected, event_id % 3 = 1 AS forbidden FROM events")
def key_allow_list(spark, sf_dir):
    """Keys of JSON text that aren't allowed, and names that are forbidden at any depth."""
    doc = F.when(F.col("event_id") % 3 == 0, F.col("props")).when(F.col("event_id") % 3 == 1, F.lit('{"a": {"Token": 1, "Token": 4}, "z": 2, "token": 3}')).otherwise('{"a": 1}')
    keys = F.array_join(audit.unexpected_keys(F.json_object_keys(doc), ["a", "b"]), ",")
    return table(spark, sf_dir, "events").select("event_id", keys.alias("unexpected"), audit.has_forbidden_key(doc, ["token"]).alias("forbidden"))


@query("""
SELECT conv_id, turn, conv_id % 3 <> 2 AS valid, CASE WHEN conv_id % 3 = 2 THEN NULL ELSE CAST(turn AS VARCHAR) END AS a, CASE WHEN conv_id % 3 = 2 THEN NULL ELSE text END AS x,
  CASE WHEN conv_id % 3 = 2 THEN NULL ELSE 'a,s' END AS names FROM (SELECT conv_id, CAST(turn AS BIGINT) AS turn, coalesce(text, '') AS text FROM conversations)""")
def json_last_value(spark, sf_dir):
    """Of doubled keys the last value counts, at any depth, in the first one's place; two values one after the other are none."""
    c = table(spark, sf_dir, "conversations").select("conv_id", big("turn").alias("turn"), F.coalesce("text", F.lit("")).alias("x"))
    turn, inner = F.col("turn").cast("string"), F.to_json(F.struct("x"))
    doubled = F.concat(F.lit('{"a": {"a": 1}, "s": {"x": 1, '), F.substring(inner, 2, 1 << 30), F.lit(', "a": '), turn, F.lit("}"))
    once = F.concat(F.lit('{"a":'), turn, F.lit(',"s":'), inner, F.lit("}"))
    doc = F.when(F.col("conv_id") % 3 == 0, doubled).when(F.col("conv_id") % 3 == 1, once).otherwise(F.concat(once, F.lit(" "), once))
    read = c.select("conv_id", "turn", json_text.object_of(json_text.canonical(doc)).alias("row"))
    found = json_text.object_of(F.col("row")["s"])["x"]
    return read.select("conv_id", "turn", F.col("row").isNotNull().alias("valid"), F.col("row")["a"].alias("a"), found.alias("x"), F.array_join(F.map_keys("row"), ",").alias("names"))


@query("""
SELECT conv_id, CAST(turn AS BIGINT) AS turn, CASE WHEN conv_id % 2 = 0
  THEN '{"role":"' || coalesce(role, '') || '","auth":{"token":"<redacted>","note":"pwd=<redacted>","list":[{"my_token":"<redacted>"}]},"inner":"{\\"api_key\\":\\"<redacted>\\",\\"n\\":1}"}'
  ELSE '{"role": "' || coalesce(role, '') || '", "n": [1, 2]}' END AS clean FROM conversations""")
def redact_nested_json(spark, sf_dir):
    """JSON text without secrets at any depth: lists and objects under a secret name go whole, JSON in strings is read, too."""
    role = F.coalesce("role", F.lit(""))
    inner = F.to_json(F.struct(F.struct(F.col("text").alias("v")).alias("api_key"), F.lit(1).alias("n")))
    auth = F.struct(F.array("text", "role").alias("token"), F.concat(F.lit("pwd="), "conv_id").alias("note"), F.array(F.struct(F.lit(5).alias("my_token"))).alias("list"))
    whole = F.to_json(F.struct(role.alias("role"), auth.alias("auth"), inner.alias("inner")))
    plain = F.concat(F.lit('{"role": "'), role, F.lit('", "n": [1, 2]}'))
    rows = table(spark, sf_dir, "conversations").select("conv_id", big("turn").alias("turn"), F.when(F.col("conv_id") % 2 == 0, whole).otherwise(plain).alias("clean"))
    return redact.redact_rows(rows)


def _own_file(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/curata-files/{uuid.uuid4().hex}/{name}"


_TURNS = """SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, nullif(text, '') AS text, CAST(row_number() OVER (ORDER BY conv_id, turn, role NULLS FIRST, nullif(text, '') NULLS FIRST) - 1 AS BIGINT) AS place FROM conversations"""


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select("conv_id", big("turn").alias("turn"), "role", fields.present(F.col("text")).alias("text"))


def _read_back(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    read = sampling.with_ordinal(rows, ["ord"], "place")  # written to the shared folder, so the file can go
    writers.clear(spark, path.rsplit("/", 1)[0], True)
    row = F.col("row")
    return read.select(row["conv_id"].cast("bigint").alias("conv_id"), row["turn"].cast("bigint").alias("turn"), fields.present(row["role"]).alias("role"), fields.present(row["text"]).alias("text"), big("place").alias("place"))


@query(_TURNS)
def one_json_document(spark, sf_dir):
    """A table as one JSON document, written by many tasks and read by many tasks, in order."""
    order = ["edge", "conv_id", "turn", "role", "text"]
    # a doubled key in each item, and an item that is no object after it
    item = F.concat(F.lit('{"turn": [0], '), F.substring(F.to_json(F.struct("conv_id", "turn", "role", "text")), 2, 1 << 30), F.lit(", 5,"))
    rows = _turns(spark, sf_dir).withColumn("edge", F.lit(1)).select(*order, item.alias("value"))
    ends = spark.createDataFrame([(0, '{"version": [1, 2], "data": ['), (2, '"end"], "n": 1}')], "edge int, value string")
    path = _own_file(spark, "turns.json")
    writers.write_lines(rows.unionByName(ends, allowMissingColumns=True).orderBy(*order).select("value"), path)
    return _read_back(spark, path, readers.read_json(spark, path))


@query(_TURNS)
def one_csv_file(spark, sf_dir):
    """A table as one CSV file with line breaks and quotes in its fields, read by many tasks, in order."""
    order = ["edge", "conv_id", "turn", "role", "text"]
    quoted = lambda c: F.concat(F.lit('"'), F.replace(F.coalesce(c, F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
    rows = _turns(spark, sf_dir).withColumn("edge", F.lit(1)).select(*order, F.concat_ws(",", "conv_id", quoted("text"), "turn", quoted("role")).alias("value"))
    names = spark.createDataFrame([(0, "conv_id,text,turn,role")], "edge int, value string")
    path = _own_file(spark, "turns.csv")
    writers.write_lines(rows.unionByName(names, allowMissingColumns=True).orderBy(*order).select("value"), path)
    return _read_back(spark, path, readers.read_csv(spark, path))


SAMPLE_SIZE, SAMPLE_SEED = 40, 6029
#: Orders at the size at which the SQL is run; its literals are drawn for it.
_ORDERS = 15_000


@query(f"""
SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders)
WHERE i IN ({", ".join(map(str, sampling.sample_places(_ORDERS, SAMPLE_SIZE, SAMPLE_SEED)))})""")
def seeded_sample(spark, sf_dir):
    """A seeded sample without replacement, by place in key order."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    numbered = sampling.with_ordinal(orders, ["o_orderkey"])
    return sampling.seeded_sample(numbered, "ord", orders.count(), SAMPLE_SIZE, SAMPLE_SEED).select("o_orderkey", "o_totalprice")


@query("""
SELECT i // 500 AS batch, CAST(count(*) AS BIGINT) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS i FROM orders) GROUP BY 1""")
def batch_assign(spark, sf_dir):
    """Consecutive batches of a fixed size."""
    numbered = sampling.with_ordinal(table(spark, sf_dir, "orders").select("o_orderkey"), ["o_orderkey"])
    return sampling.batches(numbered, "ord", 500).groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("SELECT substr(sha256(coalesce(text, '')), 1, 12) AS text_hash, CAST(count(*) AS BIGINT) AS n_rows, min(doc_id) AS first_label FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(spark, sf_dir):
    """Ids that occur again, with where they were first."""
    return audit.duplicate_ids(table(spark, sf_dir, "documents").select(identity.stable_hash("text").alias("text_hash"), "doc_id"), "text_hash", "doc_id")


@query("""
WITH h AS (SELECT doc_id, sha256(coalesce(text, '')) AS s, source FROM documents), n AS (SELECT *, row_number() OVER (PARTITION BY substr(s, 1, 12) ORDER BY doc_id) - 1 AS n FROM h)
SELECT doc_id, CASE WHEN n = 0 THEN substr(s, 1, 12) ELSE substr(s, 1, 12) || '__dup_' || n || '_' || substr(sha256(source), 1, 8) END AS unique_id FROM n""")
def dup_disambiguate(spark, sf_dir):
    """Repeated ids with a place and a hash."""
    rows = table(spark, sf_dir, "documents").select("doc_id", identity.stable_hash("text").alias("id"), "source")
    return identity.disambiguated(rows, "id", ["doc_id"], identity.stable_hash("source", length=8)).select("doc_id", "unique_id")


@query("SELECT l_returnflag || l_linestatus AS split, CAST(count(*) AS BIGINT) AS n_rows, min(l_orderkey) AS first_key, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY 1")
def group_by_split(spark, sf_dir):
    """Rows by split."""
    rows = table(spark, sf_dir, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("split"), "l_orderkey", "l_quantity")
    return rows.groupBy("split").agg(F.count("*").alias("n_rows"), F.min("l_orderkey").alias("first_key"), F.sum("l_quantity").alias("quantity"))


@query("""
SELECT 'customer' AS benchmark_id, c_name AS record_id, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplier', s_name, s_nationkey FROM supplier""")
def union_order(spark, sf_dir):
    """Rows of several packages in one order."""
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("benchmark_id"), F.col("c_name").alias("record_id"), F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("benchmark_id"), F.col("s_name").alias("record_id"), F.col("s_nationkey").alias("nation"))
    return report.union_sorted([s, c], ["benchmark_id", "record_id"])


# ---------------------------------------------------------------- literals, labels, row rules


_UNITS, _MONEY = ("MHz", "kPa", "Jan", "sept", "sqft", "days", "Inc", "mL", "pieces", "hours", "mhz"), ("usd", "Euro", "llc", "pounds", "n/a", "krw each")


def _values(spark, sf_dir) -> DataFrame:
    size = F.col("p_size").cast("string")
    kinds = {
        "brand": [F.col("p_brand")], "kilo": [F.concat(F.lit("(A) "), size, F.lit(" kg"))], "words": [F.concat(size, F.lit(" small rings"))], "name": [F.col("p_name")],
        "lines": [F.concat(F.lit("A. "), size, F.lit("\nB. "), F.col("p_type"))], "units": [F.concat(size, F.lit(f" {u}")) for u in _UNITS],
    }
    each = lambda t, kinds: table(spark, sf_dir, t).select(F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), v.alias("value")) for k, values in kinds.items() for v in values))).alias("v")).select("v.*")
    # one scan of each table, and distinct once over all
    rows = each("part", kinds).unionByName(each("orders", {"priority": [F.col("o_orderpriority")]})).unionByName(each("customer", {"segment": [F.col("c_mktsegment")]}))
    return rows.unionByName(each("region", {"money": [F.lit(m) for m in _MONEY]})).distinct()


_VALUES_SQL = """
v AS (SELECT DISTINCT 'brand' AS kind, p_brand AS value FROM part UNION ALL SELECT DISTINCT 'kilo', '(A) ' || p_size || ' kg' FROM part UNION ALL SELECT DISTINCT 'words', p_size || ' small rings' FROM part
  UNION ALL SELECT DISTINCT 'name', p_name FROM part UNION ALL SELECT DISTINCT 'lines', 'A. ' || p_size || chr(10) || 'B. ' || p_type FROM part
  UNION ALL SELECT DISTINCT 'priority', o_orderpriority FROM orders UNION ALL SELECT DISTINCT 'segment', c_mktsegment FROM customer
  UNION ALL SELECT DISTINCT 'units', p_size || ' ' || u FROM part, (SELECT unnest(['MHz', 'kPa', 'Jan', 'sept', 'sqft', 'days', 'Inc', 'mL', 'pieces', 'hours', 'mhz']) AS u) UNION ALL SELECT 'money', unnest(['usd', 'Euro', 'llc', 'pounds', 'n/a', 'krw each'])),
l AS (SELECT kind, value, trim(x) AS line, trim(regexp_replace(trim(x), '^\\s*\\([A-Z0-9]+\\)\\s*', '')) AS p FROM (SELECT kind, value, unnest(string_split(value, chr(10))) AS x FROM v)),
t AS (SELECT kind, value, CASE WHEN p <> line THEN p ELSE trim(regexp_replace(line, '^\\s*([A-Z]|[0-9]+)[.):]\\s*', '')) END AS t FROM l),
f AS (SELECT kind, value, t, t = '' OR regexp_matches(t, '(?i)^(?:box|image|figure|panel|photo|picture)\\s+[A-Z0-9]+$')
    OR regexp_matches(t, '^(?:[A-Z][A-Z0-9&/+.$%-]*|[A-Za-z]{1,5}[0-9]+[A-Za-z0-9]*|[0-9]+[A-Za-z]{1,5}[A-Za-z0-9]*)$') OR regexp_matches(t, '^[A-Z][A-Za-z0-9&.''-]*(?:\\s+[A-Z][A-Za-z0-9&.''/-]*){0,4}$')
    OR (regexp_matches(t, '[0-9]') AND len(list_filter(regexp_extract_all(t, '[A-Za-z]+'), lambda x: length(x) > 1 AND upper(x) <> x AND x NOT IN (
      'cm', 'mm', 'km', 'kg', 'mg', 'ms', 'Pa', 'kPa', 'MPa', 'kJ', 'kW', 'Hz', 'kHz', 'MHz', 'mol', 'mL', 'ml', 'vol', 'Co', 'Inc', 'to', 'day', 'days', 'yr', 'yrs', 'year', 'years',
      'Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun', 'Jul', 'Aug', 'Sep', 'Sept', 'Oct', 'Nov', 'Dec', 'jan', 'feb', 'mar', 'apr', 'may', 'jun', 'jul', 'aug', 'sep', 'sept', 'oct', 'nov', 'dec',
      'bn', 'mn', 'Mi', 'ft', 'sq', 'sqft', 'Sqft'))) = 0)
    OR upper(t) IN ('NA', 'N/A', 'AUD', 'CAD', 'CHF', 'CNY', 'EUR', 'EURO', 'GBP', 'HKD', 'JPY', 'KRW', 'RMB', 'USD', 'LLC') AS literal FROM t)"""


@query(f"WITH {_VALUES_SQL} SELECT kind, value, bool_and(literal) AS nonlinguistic FROM f GROUP BY kind, value".replace("\\\\", "\\"))
def nonlinguistic(spark, sf_dir):
    """Values that have nothing to translate: codes, names, numbers with units."""
    return _values(spark, sf_dir).select("kind", "value", text.is_nonlinguistic(F.col("value")).alias("nonlinguistic"))


@query(f"""WITH {_VALUES_SQL},
s AS (SELECT kind, value, literal, regexp_matches(t, '^[a-z]{{1,4}}\\.?(?:\\s+[a-z]{{1,4}}\\.?){{0,2}}$') AND len(list_intersect(string_split(t, ' '), ['blue', 'day', 'gray', 'grey', 'no', 'pink', 'red', 'year', 'yes'])) = 0 AS short FROM
  (SELECT kind, value, t, literal FROM f UNION ALL SELECT 'word', w, w, NULL FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part)))
SELECT kind, value, bool_and(short OR (kind = 'lines' AND literal)) AS short_literal FROM s GROUP BY kind, value""".replace("\\\\", "\\"))
def short_literal(spark, sf_dir):
    """Up to three short lower-case words that are none of the plain ones."""
    words = table(spark, sf_dir, "part").select(F.lit("word").alias("kind"), F.explode(F.split("p_name", " ")).alias("value")).distinct()
    rows = _values(spark, sf_dir).unionByName(words)
    return rows.select("kind", "value", text.is_short_literal(F.col("value")).alias("short_literal"))


_PLACES_SQL = """
p AS (SELECT kind, value, CASE WHEN length(value) % 2 = 0 THEN 'mme_realworld' ELSE 'blink' END AS benchmark, CASE length(value) % 3 WHEN 0 THEN 'options' WHEN 1 THEN 'text_fields.options' ELSE 'text_fields.options.a' END AS path,
  CASE length(value) % 4 WHEN 0 THEN 'x/ocr_cc/1' WHEN 1 THEN 'z' WHEN 2 THEN 'diagram_and_table/2' ELSE 'other' END AS source FROM (SELECT DISTINCT kind, value FROM v))"""


def _places(rows: DataFrame) -> DataFrame:
    n = F.length("value")
    return rows.select(
        "kind", "value", F.when(n % 2 == 0, "mme_realworld").otherwise("blink").alias("benchmark"), F.when(n % 3 == 0, "options").when(n % 3 == 1, "text_fields.options").otherwise("text_fields.options.a").alias("path"),
        F.when(n % 4 == 0, "x/ocr_cc/1").when(n % 4 == 1, "z").when(n % 4 == 2, "diagram_and_table/2").otherwise("other").alias("source"),
    )


@query(f"""WITH {_VALUES_SQL}, {_PLACES_SQL},
s AS (SELECT kind, value, literal, regexp_matches(t, '^[a-z]{{1,4}}\\.?(?:\\s+[a-z]{{1,4}}\\.?){{0,2}}$') AND len(list_intersect(string_split(t, ' '), ['blue', 'day', 'gray', 'grey', 'no', 'pink', 'red', 'year', 'yes'])) = 0 AS short FROM f),
g AS (SELECT kind, value, bool_and(literal) AS literal, bool_and(short OR (kind = 'lines' AND literal)) AS short FROM s GROUP BY kind, value)
SELECT p.kind, p.value, path IN ('options', 'text_fields.options') AND (literal OR (benchmark = 'mme_realworld' AND (contains(source, 'ocr_cc/') OR (contains(source, 'diagram_and_table/') AND short)))) AS exempt
FROM p JOIN g ON g.kind = p.kind AND g.value = p.value""".replace("\\\\", "\\"))
def exempt_literals(spark, sf_dir):
    """Values that need no Korean where they stand: literals among options, and more in scans and tables of one benchmark."""
    return _places(_values(spark, sf_dir)).select("kind", "value", text.allows_nonlinguistic(F.col("benchmark"), F.col("path"), F.col("value"), F.col("source")).alias("exempt"))


@query(f"WITH {_VALUES_SQL}, {_PLACES_SQL} SELECT kind, value, benchmark = 'mme_realworld' AND contains(source, 'ocr_cc/') AS exempt FROM p".replace("\\\\", "\\"))
def exempt_ideographs(spark, sf_dir):
    """Rows in which ideographs of the source may stay."""
    return _places(_values(spark, sf_dir)).select("kind", "value", text.allows_ideographs(F.col("benchmark"), F.col("source")).alias("exempt"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'A. ' || lower(p_type) WHEN 1 THEN 'A) ' || lower(p_type) WHEN 2 THEN lower(p_type) ELSE '12: ' || lower(p_type) END AS repaired FROM part""")
def option_label_repair(spark, sf_dir):
    """A leading option label that a translation lost comes back; one that it kept stays as it is."""
    k, low = F.col("p_partkey") % 4, F.lower("p_type")
    source = F.when(k == 0, F.concat(F.lit("A. "), "p_type")).when(k == 1, F.concat(F.lit("A. "), "p_type")).when(k == 2, F.concat(F.lit("(A) "), "p_type")).otherwise(F.concat(F.lit(" 12: "), "p_type"))
    translated = F.when(k == 1, F.concat(F.lit("A) "), low)).otherwise(low)
    return table(spark, sf_dir, "part").select("p_partkey", text.keep_option_label(source, translated).alias("repaired"))


@query("""
WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
t AS (SELECT conv_id, turn, CASE WHEN trim(text) = '' THEN text ELSE '한국어 번역 초안: ' || role || ': ' || text END AS said FROM m)
SELECT conv_id, turn, CASE WHEN trim(said) = '' THEN 'field is empty' ELSE concat_ws('|', CASE WHEN regexp_matches(said, '(?i)\\bassistant\\b') THEN 'field text_fields.question item 0 has assistant text' END) END AS errors FROM t""".replace("\\\\", "\\"))
def mock_translation_qc(spark, sf_dir):
    """The mock translation, and what the leaf rules say of it."""
    said = F.coalesce("text", F.lit(""))
    done = F.when(text.trimmed(said) == "", said).otherwise(text.mock_translate(F.concat("role", F.lit(": "), said)))
    leaves = F.filter(F.array(F.struct(F.lit("text_fields.question").alias("path"), done.alias("text"))), lambda x: text.trimmed(x["text"]) != "")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_join(validate.leaf_errors(leaves, F.lit(""), F.lit("")), "|").alias("errors"))


@query("""
WITH o AS (SELECT l_orderkey, count(*) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY 1)
SELECT l_orderkey, CASE WHEN m = 7 THEN 'options missing' WHEN n <> m THEN 'options differ' ELSE '' END AS error FROM o""")
def option_alignment(spark, sf_dir):
    """Counts of options on both sides of a row."""
    rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.max("l_linenumber").alias("m"))
    error = validate.option_alignment(F.col("n"), F.when(F.col("m") != 7, F.col("m")))
    return rows.select("l_orderkey", F.coalesce(error, F.lit("")).alias("error"))


@query("""
WITH c AS (SELECT conv_id * 1000 + turn AS id, turn, role, text FROM conversations)
SELECT id, 'not translated' AS error FROM c WHERE turn = 0
UNION ALL SELECT id, 'missing question' FROM c WHERE turn = 1
UNION ALL SELECT id, 'options differ' FROM c WHERE turn = 2
UNION ALL SELECT id, 'options missing' FROM c WHERE turn = 3
UNION ALL SELECT id, 'no source' FROM c WHERE turn = 4
UNION ALL SELECT id, 'no source id' FROM c WHERE turn = 5
UNION ALL SELECT id, 'field is empty' FROM c WHERE turn <> 0 AND trim(coalesce(text, '')) = ''
UNION ALL SELECT id, 'field question item 0 has no Korean text' FROM c WHERE turn <> 0 AND trim(coalesce(text, '')) <> '' AND role = 'user'""")
def row_errors(spark, sf_dir):
    """Every rule that a row breaks, one row each."""
    t = F.col("turn")
    said = F.when(F.col("role") == "user", F.col("text")).otherwise(text.mock_translate(F.col("text")))
    rows = table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + t).alias("id"), F.when(t != 0, F.create_map(F.lit("question"), F.coalesce("text", F.lit("")))).alias("translated"),
        F.when(t == 1, F.array(F.lit("question"), F.lit("caption"))).otherwise(F.array().cast("array<string>")).alias("missing"), F.when(t != 4, "s").alias("source"), F.when(t == 5, "").otherwise("x").alias("source_id"), F.lit("b").alias("benchmark_id"),
        F.filter(F.array(F.struct(F.lit("question").alias("path"), F.coalesce(said, F.lit("")).alias("text"))), lambda x: text.trimmed(x["text"]) != "").alias("leaves"),
        F.when(t.isin(2, 3), 4).alias("n_source"), F.when(t == 2, 5).alias("n_translated"),
    )
    return validate.row_errors(rows, "id", "translated", "missing", "source", "source_id", "benchmark_id", "leaves", "n_source", "n_translated")


# ---------------------------------------------------------------- reports


@query("""
WITH j AS (SELECT d.text, d.lang, CASE WHEN d.source = 'src1' THEN '' ELSE d.source END AS source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT f.field, CAST(CASE f.field WHEN 'text' THEN count(*) FILTER (WHERE coalesce(text, '') = '') WHEN 'lang' THEN count(*) FILTER (WHERE coalesce(lang, '') = '') WHEN 'source' THEN count(*) FILTER (WHERE coalesce(source, '') = '')
  WHEN 'quality' THEN count(*) FILTER (WHERE quality IS NULL) ELSE count(*) FILTER (WHERE toxic IS NULL) END AS BIGINT) AS n_missing, CAST(count(*) AS BIGINT) AS n_rows
FROM j, (VALUES ('text'), ('lang'), ('source'), ('quality'), ('toxic')) f(field) GROUP BY f.field""")
def missing_histogram(spark, sf_dir):
    """Missing values by field, in one pass."""
    d = table(spark, sf_dir, "documents").withColumn("source", F.when(F.col("source") == "src1", "").otherwise(F.col("source")))
    return report.missing_histogram(d.join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["text", "lang", "source", "quality", "toxic"])


@query("""
WITH j AS (SELECT d.doc_id, d.lang, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT * FROM (SELECT doc_id, concat_ws(',', CASE WHEN lang <> 'en' THEN 'question_missing_or_not_korean' END, CASE WHEN source = 'src2' THEN 'primary_media_missing' END, CASE WHEN quality IS NULL THEN 'media_files_empty' END,
  CASE WHEN quality = 0 THEN 'media_file_path_missing' END, CASE WHEN toxic = 1 THEN 'assistant_artifact_text' END, CASE WHEN doc_id % 5 = 1 THEN 'options_missing_or_unparseable' END, CASE WHEN doc_id % 5 = 2 THEN 'options_cardinality_mismatch' END) AS reasons FROM j) WHERE reasons <> ''""")
def review_candidates(spark, sf_dir):
    """Rows to look at, with the reasons."""
    j = table(spark, sf_dir, "documents").select("doc_id", "lang", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    k = F.col("doc_id") % 5
    reasons = validate.review_reasons(
        F.when(F.col("lang") == "en", "질문").otherwise("question"), F.when(F.col("source") != "src2", F.col("source")), F.when(F.col("quality").isNotNull(), F.array("source")), F.coalesce(F.col("quality") == 0, F.lit(False)),
        F.array(F.when(F.col("toxic") == 1, "Note\n Assistant: hello").otherwise("the assistant manager")), F.lit('["a", "b"]'), F.when(k == 1, "no json").when(k == 2, '{"a": 1}').otherwise('[1, 2]'),
    )
    return j.select("doc_id", F.array_join(reasons, ",").alias("reasons")).where("reasons <> ''")


@query("""
WITH j AS (SELECT d.lang, l.doc_id IS NOT NULL AS done, coalesce(l.quality = 1, false) AS ok, d.n_chars FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT CASE WHEN grouping(lang) = 1 THEN 'total' ELSE lang END AS lang, CAST(count(*) FILTER (WHERE done) + count(*) FILTER (WHERE NOT done) AS BIGINT) AS source_count, CAST(count(*) FILTER (WHERE done) AS BIGINT) AS translated_count,
  CAST(CASE WHEN bool_and(ok) THEN count(*) FILTER (WHERE done) ELSE 0 END AS BIGINT) AS valid_count, CAST(count(*) FILTER (WHERE NOT done) + CASE WHEN bool_and(ok) THEN 0 ELSE count(*) FILTER (WHERE done) END AS BIGINT) AS invalid_count,
  CAST(count(*) FILTER (WHERE NOT done) AS BIGINT) AS failure_count, CAST(sum(n_chars) AS BIGINT) AS n_chars FROM j GROUP BY ROLLUP (lang)""")
def qc_report_rollup(spark, sf_dir):
    """A report by group with the total of all."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality", F.lit(True).alias("done"))
    j = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars").join(labels, "doc_id", "left")
    done, ok = F.coalesce("done", F.lit(False)), F.coalesce(F.col("quality") == 1, F.lit(False))
    return report.with_total(j, "lang", [*report.translation_stats(done, ~done, ok), F.sum("n_chars").alias("n_chars")])


@query("SELECT lang, doc_id, substr(text, 1, 160) AS preview FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS n FROM documents) WHERE n <= 3")
def top_examples(spark, sf_dir):
    """The first rows of each group, in short."""
    rows = table(spark, sf_dir, "documents").select("lang", "doc_id", F.substring("text", 1, 160).alias("preview"))
    return report.top_examples(rows, "lang", ["doc_id"], 3)


@query("SELECT d.source, CASE WHEN coalesce(bool_or(l.toxic = 1 AND l.quality = 0), false) THEN 'needs_review' ELSE 'passed' END AS status FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1")
def status_fold(spark, sf_dir):
    """One status over many rows."""
    j = table(spark, sf_dir, "documents").select("doc_id", "source").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return j.groupBy("source").agg(report.status((F.col("toxic") == 1) & (F.col("quality") == 0)).alias("status"))


# ---------------------------------------------------------------- media

_REFS = r"""(?:src|href)="([^"]*)\""""


def _refs(spark, sf_dir) -> DataFrame:
    refs = F.regexp_extract_all("html", F.lit(r'(?:src|href)="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", refs.alias("refs"))


@query("""
SELECT page_id, CAST(len(r) AS BIGINT) AS n_refs, array_to_string(list_sort(list_distinct(list_filter(r, lambda x: x <> ''))), ' ') AS media FROM (SELECT page_id, regexp_extract_all(html, '(?:src|href)="([^"]*)"', 1) AS r FROM pages)""")
def media_extract(spark, sf_dir):
    """Distinct references of a page, sorted."""
    return _refs(spark, sf_dir).select("page_id", big(F.size("refs")).alias("n_refs"), F.array_join(nested.media_list(F.col("refs")), " ").alias("media"))


@query(r"""
WITH r AS (SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN '/data/a/' || page_id || '.png' ELSE 'a\b\' || page_id || '.png' END AS ref FROM pages)
SELECT page_id, CASE page_id % 3 WHEN 0 THEN '<remote-media>' WHEN 1 THEN page_id || '.png' ELSE 'a/b/' || page_id || '.png' END AS clean, page_id % 3 = 0 AS remote FROM r""")
def media_clean_ref(spark, sf_dir):
    """References that are safe to publish."""
    k, number = F.col("page_id") % 3, F.concat(F.col("page_id").cast("string"), F.lit(".png"))
    ref = F.when(k == 0, F.col("url")).when(k == 1, F.concat(F.lit("/data/a/"), number)).otherwise(F.concat(F.lit("a\\b\\"), number))
    return table(spark, sf_dir, "pages").select("page_id", media.clean_ref(ref).alias("clean"), text.is_remote_ref(ref).alias("remote"))


@query(r"""
SELECT page_id, substr(sha256(url), 1, 16) || '-' || substr(coalesce(nullif(trim(regexp_replace(url, '[^\p{L}\p{N}._-]+', '_', 'g'), '._-'), ''), 'media'), 1, 48) || '.' || CASE WHEN page_id % 2 = 0 THEN 'png' ELSE 'bin' END AS name FROM pages""")
def media_filename(spark, sf_dir):
    """Content-addressed file names."""
    suffix = F.when(F.col("page_id") % 2 == 0, "PNG").otherwise("")
    return table(spark, sf_dir, "pages").select("page_id", media.file_name(F.col("url"), F.col("url"), suffix).alias("name"))


@query("""
WITH r AS (SELECT page_id, unnest(regexp_extract_all(html, '(?:src|href)="([^"]*)"', 1)) AS ref, generate_subscripts(regexp_extract_all(html, '(?:src|href)="([^"]*)"', 1), 1) AS pos FROM pages),
d AS (SELECT DISTINCT ref FROM r), x AS (SELECT ref, CASE WHEN length(ref) % 3 = 0 THEN ref WHEN length(ref) % 3 = 1 THEN 'b.zip!' || ref END AS found FROM d)
SELECT r.page_id AS id, coalesce(string_agg(found, ' ' ORDER BY pos) FILTER (WHERE found IS NOT NULL), '') AS media_files, coalesce(string_agg(r.ref, ' ' ORDER BY pos) FILTER (WHERE found IS NULL), '') AS missing, CAST(count(*) AS BIGINT) AS n_refs
FROM r JOIN x ON x.ref = r.ref GROUP BY r.page_id""")
def media_resolve(spark, sf_dir):
    """References against files and archive members: what is found where, and what is missing."""
    refs = _refs(spark, sf_dir).select(F.col("page_id").alias("id"), F.posexplode("refs").alias("pos", "ref"))
    known = refs.select("ref").distinct()
    files = known.where(F.length("ref") % 3 == 0).select(F.col("ref").alias("path"), F.lit(0).alias("root_ord"))
    members = known.where(F.length("ref") % 3 == 1).select(F.col("ref").alias("member"), F.explode(F.array(F.lit("c.zip"), F.lit("b.zip"))).alias("archive"))
    members = members.withColumn("archive_ord", F.when(F.col("archive") == "b.zip", 1).otherwise(2))
    done = media.package(media.resolve(refs, files, members))
    return done.select("id", F.array_join("media_files", " ").alias("media_files"), F.array_join("missing", " ").alias("missing"), "n_refs")


# ---------------------------------------------------------------- the resumable map


def refuse_errors(source: dict, result: dict | None) -> list[str]:
    """The default check, and as a service would, no error events."""
    return transform.problems(source, result) + ["refused"] * (source.get("question") == "error")


@query("""
SELECT event_id AS ord, event_type <> 'error' AS ok, CASE WHEN event_type = 'error' THEN '{"question": "error"}' ELSE '{"question": "한국어 번역 초안: ' || event_type || '"}' END AS text_fields, CASE WHEN event_type = 'error' THEN 'refused' ELSE '' END AS errors FROM events""")
def resumable_map(spark, sf_dir):
    """The map as a stream that takes what is new: accepted rows and dead letters of one run over all events."""
    schema = table(spark, sf_dir, "events").schema
    prepare = lambda df: df.select(F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("source_id"), F.create_map(F.lit("question"), F.col("event_type")).alias("text_fields"))
    out = f"{shared_dir(spark)}/curata/resumable-{uuid.uuid4().hex}"
    resumable.run_available(spark, f"{sf_dir}/events.parque[t]", schema, prepare, out, f"{out}/checkpoint", check=refuse_errors, batch_size=64)
    rows = spark.read.schema(transform.OUTPUT.replace("ok boolean", "part string")).parquet(f"{out}/rows")
    return rows.select("ord", (F.col("part") == "ok").alias("ok"), "text_fields", F.array_join("errors", "|").alias("errors"))
