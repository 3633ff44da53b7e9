"""The registered queries of this subpackage, with DuckDB SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, conversations, decontaminate, hnsw, licenses, minhash_join, mixing, ppm, resampling, substring_dedup, token_counts,
    toxicity, url_filter,
)
from tidemark.operators.joins import join_same
from tidemark.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings of this subpackage: whole texts are long, so fewer of them go into a batch."""
    tune(spark)
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", "256")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def query(key: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepared(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            CHECKS[key] = sql
        return fn

    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def byte_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def token_digests(docs: DataFrame, path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 from the operator's ids and decoded texts."""
    return bpe.decode(bpe.encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["ids"] if keep_ids else []),
    )


def remainder(name: str = "doc_id"):
    """crc32 of the id as text, modulo 5: the folds of the learning queries."""
    return F.crc32(F.col(name).cast("string").cast("binary")) % 5


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").where(remainder() != 0)
    result = toxicity.scored(table(spark, sf, "documents"), labels)
    return result.select("doc_id", (remainder() == 0).alias("held_out"), "score", "predicted", "evidence")


@query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.find(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query("op3_substring_dedup")
def op3_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    result = substring_dedup.dedup(table(spark, sf, "documents"), window=50)
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"), "spans")


@query("op4_bpe")
def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return token_digests(table(spark, sf, "documents"), word_vocabulary())


@query("op5_ppm")
def op5_ppm(spark: SparkSession, sf: str) -> DataFrame:
    result = ppm.scored(table(spark, sf, "documents"), remainder() != 1)
    return result.select(
        "doc_id", (remainder() == 1).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query("op6_hnsw")
def op6_hnsw(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "embeddings")
    return hnsw.nearest(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op7_minhash_join")
def op7_minhash_join(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_join.near_duplicates(table(spark, sf, "documents"), shingle=3, percent=85)


# The rules of the query, (action, host, path).
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
URL_SQL = f"""
WITH split AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM split
), rules(action, rule_host, rule_path) AS (VALUES {", ".join(str(r) for r in URL_RULES)})
SELECT page_id, host, path,
  (SELECT max_by(rule_host || rule_path, length(rule_host || rule_path)) FROM rules
   WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS rule,
  coalesce((SELECT max_by(action, length(rule_host || rule_path)) FROM rules
   WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)), 'allow') AS verdict
FROM parts
"""


@query("op8_url_filter", URL_SQL)
def op8_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf, "pages"), URL_RULES)


# Edits that a cleaning pass makes: (pattern, text in its place).
REDACTIONS = [
    (r"(?<![\w.+-])[\w.+-]++@[\w-]+(?:\.[\w-]+)+", "<EMAIL>"),
    (r"AKIA[0-9A-Z]{16}", "<KEY>"),
    (r"([#$%&*])\1{2,}", " "),
]


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.counted(table(spark, sf, "documents"), byte_ranks(), REDACTIONS)


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scanned(table(spark, sf, "documents"))


@query("op11_mixing")
def op11_mixing(spark: SparkSession, sf: str) -> DataFrame:
    result = mixing.mixed(table(spark, sf, "documents"), weights=(5, 2, 1), most=3)
    return result.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


# CRC-32 of a text in SQL: the table of its 256 bytes, then one step for each byte.
CRC_TABLE = """crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS steps FROM (
  SELECT i, list_reduce(list_prepend(i::UBIGINT, [0,0,0,0,0,0,0,0]::UBIGINT[]), lambda c, z: xor(c >> 1, (c & 1) * 3988292384)) AS v
  FROM range(256) r(i)))"""


def crc_sql(text: str, steps: str = "steps") -> str:
    byte = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex({text}), CAST(2 * i - 1 AS INT), 2))::UBIGINT)"
    return f"""CAST(xor(list_reduce(list_prepend(4294967295::UBIGINT, {byte}),
      lambda c, b: xor(c >> 8, {steps}[CAST((xor(c, b) & 255) + 1 AS INT)])), 4294967295) AS BIGINT)"""


def damaged(turns: DataFrame) -> DataFrame:
    """Faults by the remainder of crc32 of `conv_id:turn`: a row is dropped, emptied, robbed of its sentence ends,
    repeated, or given to the user. Nulls count as one space."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")]
    fault = F.crc32(F.concat_ws(":", *shown[:2]).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", shown[2].alias("role"), shown[3].alias("text"), fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair_sql() -> str:
    """The cheapest edits row by row: for each state the least (cost, audit) with the repaired lines so far."""
    def step(k: str, cost: int | str, letter: str, line: str = "''") -> str:
        return f"CASE WHEN {k} IS NOT NULL THEN {{'c': {k}.c + {cost}, 'a': {k}.a || '{letter}', 't': {k}.t || {line}}} END"

    def least(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    added = {name: f"chr(10) || '{name}:'" for name in ("user", "assistant")}
    given = {name: f"{line} || text" for name, line in added.items()}
    more, keep = "(CASE WHEN cut THEN 3 ELSE 0 END)", "chr(10) || role || ':' || text"

    def stays(*ways: str) -> list[str]:
        return [f"CASE WHEN NOT gone THEN {w} END" for w in ways]

    def kept(initial: str, *ks: str) -> list[str]:
        return [f"CASE WHEN NOT gone AND left(role, 1) = '{initial}' THEN {step(k, more, 'K', keep)} END" for k in ks]

    def reroled(name: str, *ks: str) -> list[str]:
        return stays(*(step(k, f"3 + {more}", "R", given[name]) for k in ks))

    def insertions(rows: str, columns: str) -> str:
        user = least("k2", *(step(k, 3, "I", added["user"]) for k in ("k0", "k1", "k3")))
        once = f"SELECT {columns}, k0, k1, {user} AS k2, k3 FROM ({rows})"
        twice = f"SELECT {columns}, k0, k1, k2, {least('k3', step('k2', 3, 'I', added['assistant']))} AS k3 FROM ({once})"
        return f"SELECT {columns}, k0, k1, {least('k2', step('k3', 3, 'I', added['user']))} AS k2, k3 FROM ({twice})"

    moved = f"""SELECT o.conv_id, o.i, {step('k0', 4, 'D')} AS k0, {least(step('k1', 4, 'D'), *kept('s', 'k0'))} AS k1,
      {least(step('k2', 4, 'D'), *kept('u', 'k0', 'k1', 'k3'), *reroled('user', 'k0', 'k1', 'k3'))} AS k2,
      {least(step('k3', 4, 'D'), *kept('a', 'k2'), *reroled('assistant', 'k2'))} AS k3
      FROM paths p JOIN rows_in_order o ON o.conv_id IS NOT DISTINCT FROM p.conv_id AND o.i = p.i + 1"""
    kind = "STRUCT(c BIGINT, a VARCHAR, t VARCHAR)"
    none = ", ".join(f"CAST(NULL AS {kind}) AS k{s}" for s in (1, 2, 3))
    begin = f"SELECT DISTINCT conv_id, 0::BIGINT AS i, {{'c': 0, 'a': '', 't': ''}}::{kind} AS k0, {none} FROM rows_in_order"
    show = "coalesce({0}::VARCHAR, ' ')"
    return f"""
WITH RECURSIVE {CRC_TABLE},
shown AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {show.format('conv_id')} || ':' || {show.format('turn')} AS name FROM conversations),
faulty AS (SELECT *, {crc_sql('name')} % 20 AS f FROM shown, crc_table),
damaged AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
  CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM faulty, range(2) copies(k) WHERE f <> 0 AND (k = 0 OR f = 3)),
numbered AS (SELECT *, row_number() OVER w AS i, left(lag(role) OVER w, 1) || left(role, 1) AS pair,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS rest
  FROM damaged WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
marked AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM numbered),
rows_in_order AS MATERIALIZED (SELECT conv_id, turn, role, text, i, rest = '' AS empty, rest <> '' AND seen AS again,
  rest <> '' AND NOT seen AND right(rest, 1) NOT IN ('.', '!', '?') AS cut, rest = '' OR seen AS gone,
  pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au') AS odd FROM marked),
paths AS ({insertions(begin, "conv_id, i")} UNION ALL {insertions(moved, "conv_id, i")}),
best AS (SELECT conv_id, {least('k0', 'k3')} AS k FROM paths p
  WHERE i = (SELECT max(i) FROM rows_in_order o WHERE o.conv_id IS NOT DISTINCT FROM p.conv_id)),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(empty) AS blank,
  count_if(again) AS duplicate, count_if(cut) AS truncated, count_if(odd) AS illegal FROM rows_in_order GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, coalesce(k.c, 0) AS cost, coalesce(k.a, '') AS audit,
  sha256(coalesce(substr(k.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id
"""


@query("op12_conversations", repair_sql())
def op12_conversations(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations")
    result = conversations.repaired(damaged(turns)).withColumnRenamed("conv", "conv_id")
    all_ids = turns.select("conv_id").distinct()
    counts = [F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return join_same(all_ids, result, ["conv_id"]).select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def features_sql(name: str) -> str:
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""{name}_words AS MATERIALIZED (SELECT *, row_number() OVER () AS nr, regexp_extract_all({low}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM {name}),
{name}_features AS (SELECT nr, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
  list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f FROM {name}_words)"""


RESAMPLING_SQL = f"""
WITH {CRC_TABLE}, {features_sql("documents")}, {features_sql("benchmark")},
hashed AS (SELECT f, {crc_sql("f")} % 10000 AS b FROM (SELECT f FROM documents_features UNION SELECT f FROM benchmark_features), crc_table),
own AS (SELECT nr, b, count(*) AS n FROM documents_features JOIN hashed USING (f) GROUP BY ALL),
corpus AS (SELECT b, sum(n) AS s FROM own GROUP BY b),
target AS (SELECT b, count(*) AS t FROM benchmark_features JOIN hashed USING (f) GROUP BY b),
gains AS (SELECT b, CAST(floor(1000 * ln(((coalesce(t, 0) + 1) * ((SELECT sum(s) FROM corpus) + 10000))::DOUBLE
  / ((s + 1) * (coalesce((SELECT sum(t) FROM target), 0) + 10000))::DOUBLE)) AS BIGINT) AS gain FROM corpus LEFT JOIN target USING (b)),
weights AS (SELECT nr, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS weight FROM own JOIN gains USING (b) GROUP BY nr),
scores AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM documents_words LEFT JOIN weights USING (nr)),
places AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) AS place FROM scores)
SELECT doc_id, n_features, weight, score, n_words,
  CASE WHEN n_words >= 20 AND place <= 5 * (SELECT count(*) FROM scores WHERE n_words >= 20) // 100 THEN place END AS rank FROM places
"""


@query("op13_resampling", RESAMPLING_SQL)
def op13_resampling(spark: SparkSession, sf: str) -> DataFrame:
    result = resampling.resampled(table(spark, sf, "documents"), table(spark, sf, "benchmark"), percent=5, least_words=20, seed=42)
    return result.select("doc_id", "n_features", "weight", "score", "rank", "n_words")
