"""Scalar functions, tokens and personal-data scans over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog import Tables, query
from tidemark.functions import personal, scalars, tokens


@query(
    "f01_strings",
    """SELECT p_partkey, length(p_name) AS len, substr(p_name, 1, 1) AS initial, p_brand || '/' || p_type AS label,
         starts_with(p_name, 'red') AS red, trim(p_name) = '' AS blank FROM part""",
)
def _(spark, sf):
    return Tables(spark, sf).part.select(
        "p_partkey", F.length("p_name").cast("long").alias("len"), scalars.initial("p_name").alias("initial"),
        F.concat_ws("/", "p_brand", "p_type").alias("label"), F.startswith("p_name", F.lit("red")).alias("red"),
        (F.trim("p_name") == "").alias("blank"),
    )


@query(
    "f02_parse",
    """SELECT n_nationkey, TRY_CAST(replace(n_name, 'NATION_', '') AS INT) AS number, TRY_CAST(n_name AS INT) AS bad FROM nation""",
)
def _(spark, sf):
    return Tables(spark, sf).nation.select(
        "n_nationkey", scalars.parse(F.regexp_replace("n_name", "NATION_", " "), "int").alias("number"),
        scalars.parse("n_name", "int").alias("bad"),
    )


@query(
    "f03_arithmetic",
    """SELECT o_orderkey, o_orderkey % 2 = 0 AS even, round(CAST(o_totalprice AS DECIMAL(18,2)) / 1000)::BIGINT AS thousands FROM orders""",
)
def _(spark, sf):
    thousands = F.round(F.col("o_totalprice").cast("decimal(18,2)") / 1000).cast("long")
    return Tables(spark, sf).orders.select(
        "o_orderkey", (F.col("o_orderkey") % 2 == 0).alias("even"), thousands.alias("thousands")
    )


@query(
    "f04_dates",
    """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE) + 7, '%Y-%m-%d') AS week_later,
         CAST(o_orderdate AS DATE) >= DATE '1995-01-01' AS recent FROM orders""",
)
def _(spark, sf):
    day = scalars.parse_date(F.date_format("o_orderdate", "yyyy/MM/dd"), "yyyy/MM/dd")
    return Tables(spark, sf).orders.select(
        "o_orderkey", F.date_add(day, 7).cast("string").alias("week_later"),
        (day >= F.lit("1995-01-01").cast("date")).alias("recent"),
    )


@query(
    "f05_json",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(NULL AS VARCHAR) AS missing FROM events""",
)
def _(spark, sf):
    return Tables(spark, sf).events.select(
        "event_id", scalars.json_field("props", "$.k", "int").alias("k"),
        scalars.json_field("props", "$.nothing").alias("missing"),
    )


@query(
    "f06_arrays",
    """SELECT doc_id, len(list_distinct(string_split(text, ' '))) AS words, list_contains(string_split(text, ' '), 'the') AS has_the
       FROM documents""",
)
def _(spark, sf):
    words = F.split("text", " ")
    return Tables(spark, sf).documents.select(
        "doc_id", F.size(F.array_distinct(words)).cast("long").alias("words"), F.array_contains(words, "the").alias("has_the")
    )


@query(
    "f07_map",
    """SELECT c_custkey, c_name AS name, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS other FROM customer""",
)
def _(spark, sf):
    entries = scalars.map_of(F.array(F.lit("name"), F.lit("segment")), F.array("c_name", "c_mktsegment"))
    return Tables(spark, sf).customer.select("c_custkey", entries.alias("m")).select(
        "c_custkey", F.col("m")["name"].alias("name"), F.col("m")["segment"].alias("segment"),
        F.try_element_at("m", F.lit("other")).alias("other"),
    )


# One row in fifty has identifiers of a wrong shape.
_BROKEN = "c_custkey % 50 = 7"
_IDS = f"""SELECT c_custkey, printf('%03d-%02d-%04d', c_custkey % 900, c_custkey % 97, c_custkey % 10000) || CASE WHEN {_BROKEN} THEN '0' ELSE '' END AS ssn,
  printf('(%03d) %03d-%04d', 200 + c_custkey % 700, c_custkey % 1000, c_custkey % 10000) || CASE WHEN {_BROKEN} THEN '0' ELSE '' END AS phone,
  lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.com' AS email FROM customer"""


def _ids(spark, sf):
    k = F.col("c_custkey")
    extra = F.when(F.expr(_BROKEN), "0").otherwise("")
    return Tables(spark, sf).spread("customer").select(
        "c_custkey",
        F.concat(F.format_string("%03d-%02d-%04d", k % 900, k % 97, k % 10000), extra).alias("ssn"),
        F.concat(F.format_string("(%03d) %03d-%04d", 200 + k % 700, k % 1000, k % 10000), extra).alias("phone"),
        F.concat(F.lower(F.regexp_replace("c_name", "#", ".")), F.lit("@"), F.lower("c_mktsegment"), F.lit(".com")).alias("email"),
    )


_SPEC = {"ssn": "ssn", "phone": "phone", "email": "email"}


@query(
    "f08_shapes",
    f"""SELECT c_custkey, regexp_full_match(ssn, '\\d{{3}}-\\d{{2}}-\\d{{4}}') AS ssn,
         regexp_full_match(phone, '\\(\\d{{3}}\\) \\d{{3}}-\\d{{4}}') AS phone,
         regexp_full_match(email, '[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{{2,}}') AS email FROM ({_IDS})""",
)
def _(spark, sf):
    return _ids(spark, sf).select("c_custkey", *[scalars.is_kind(c, kind).alias(c) for c, kind in _SPEC.items()])


_ROW_TEXT = """(length(CAST(event_id AS VARCHAR)) || ':' || event_id || coalesce(length(CAST(nullif(user_id, 3) AS VARCHAR)) || ':' || nullif(user_id, 3), '~')
  || coalesce(length(props) || ':' || props, '~'))"""


@query(
    "f09_checksum",
    f"""SELECT event_type, count(*) || ':' || CAST(sum(CAST('0x' || md5({_ROW_TEXT})[1:15] AS BIGINT)) AS VARCHAR) AS checksum
       FROM events GROUP BY event_type""",
)
def _(spark, sf):
    events = Tables(spark, sf).events.select("event_type", "event_id", F.nullif("user_id", F.lit(3)).alias("user_id"), "props")
    return events.groupBy("event_type").agg(scalars.file_checksum(["event_id", "user_id", "props"]).alias("checksum"))


@query(
    "f10_attribute_hash",
    """SELECT c_custkey, sha256('{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}') AS h FROM customer""",
)
def _(spark, sf):
    return Tables(spark, sf).customer.select("c_custkey", scalars.attribute_hash(["c_name", "c_mktsegment"]).alias("h"))


_SHIFTED = """list_aggregate(list_transform(range(1, length({x}) + 1), lambda i:
  CAST((CAST(substr({x}, i, 1) AS INT) + 42 + i - 1) % 10 AS VARCHAR)), 'string_agg', '')"""
_MOVED = """list_aggregate(list_transform(range(1, length({x}) + 1), lambda i:
  CASE WHEN strpos('{a}', substr({x}, i, 1)) = 0 THEN substr({x}, i, 1)
  ELSE substr('{a}', (strpos('{a}', substr({x}, i, 1)) - 1 + 42 + i - 1) % 64 + 1, 1) END), 'string_agg', '')"""


@query(
    "f20_obfuscate",
    f"""WITH p AS (SELECT c_custkey, replace(ssn, '-', '') AS s, regexp_replace(phone, '[^0-9]', '', 'g') AS p,
           split_part(email, '@', 1) AS a, split_part(email, '@', 2) AS d FROM ({_IDS}) WHERE NOT {_BROKEN}),
       q AS (SELECT c_custkey, {_SHIFTED.format(x='s')} AS s, {_SHIFTED.format(x='p')} AS p,
           {_MOVED.format(x='a', a=tokens.ALPHABET)} || '@' || {_MOVED.format(x='d', a=tokens.ALPHABET)} AS email FROM p)
       SELECT c_custkey, email, s[1:3] || '-' || s[4:5] || '-' || s[6:9] AS ssn,
         '(' || p[1:3] || ') ' || p[4:6] || '-' || p[7:10] AS phone, 0 AS rejects FROM q
       UNION ALL SELECT c_custkey, NULL, NULL, NULL, 2 FROM customer WHERE {_BROKEN}""",
)
def _(spark, sf):
    out = tokens.tokenize_columns(_ids(spark, sf), _SPEC)
    return out.select("c_custkey", "ssn", "phone", "email", F.size("reject_reasons").alias("rejects"))


@query(
    "f20_keyed_round_trip",
    f"""SELECT c_custkey, ssn, phone, email, true AS shapes_kept FROM ({_IDS}) WHERE NOT {_BROKEN}""",
)
def _(spark, sf):
    hidden = tokens.tokenize_columns(_ids(spark, sf), _SPEC, key="k-2024", version=3).filter(F.size("reject_reasons") == 0)
    kept = F.lit(True)
    for col, kind in _SPEC.items():
        kept = kept & scalars.is_kind(col, kind)
    back = tokens.detokenize_columns(hidden.withColumn("shapes_kept", kept), _SPEC, key="k-2024", version=3)
    return back.select("c_custkey", "ssn", "phone", "email", "shapes_kept")


@query(
    "f20_audit",
    f"""SELECT 'INFO' AS level, op AS operation, count(*) AS n FROM customer, (VALUES ('SSN_ENCRYPT'), ('PHONE_ENCRYPT'), ('EMAIL_ENCRYPT')) o(op)
       WHERE NOT {_BROKEN} GROUP BY 1, 2
       UNION ALL SELECT 'ERROR', 'ENCRYPT_ERROR', count(*) FROM customer WHERE {_BROKEN} HAVING count(*) > 0""",
)
def _(spark, sf):
    audit = tokens.token_audit(tokens.tokenize_columns(_ids(spark, sf), _SPEC), _SPEC, "c_custkey")
    return audit.groupBy("level", "operation").agg(F.count("*").alias("n"))


_EMAIL = "[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}"
_PHONE = "\\(\\d{3}\\) \\d{3}-\\d{4}"


@query(
    "f21_scan",
    f"""SELECT doc_id, len(regexp_extract_all(text, '{_EMAIL}')) AS n_email, len(regexp_extract_all(text, '{_PHONE}')) AS n_phone,
         len(regexp_extract_all(text, '\\d{{3}}-\\d{{2}}-\\d{{4}}')) AS n_ssn FROM documents""",
)
def _(spark, sf):
    counted = personal.scan(Tables(spark, sf).spread("documents"), "text")
    return counted.select("doc_id", *[F.col(c).cast("long").alias(c) for c in ("n_email", "n_phone", "n_ssn")])


@query(
    "f21_mask",
    f"""SELECT doc_id, md5(regexp_replace(regexp_replace(regexp_replace(text, '\\d{{3}}-\\d{{2}}-\\d{{4}}', '[SSN]', 'g'),
         '{_EMAIL}', '[EMAIL]', 'g'), '{_PHONE}', '[PHONE]', 'g')) AS masked FROM documents""",
)
def _(spark, sf):
    return Tables(spark, sf).spread("documents").select("doc_id", F.md5(personal.mask_text("text")).alias("masked"))
