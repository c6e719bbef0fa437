"""The registered query of every operator, over its whole table, and DuckDB text where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_dir
from . import chat, decontam, language, mixing, pii, quality, ranked, repair, secrets, simhash, suffix, tokenids, topk
from .common import in_fold, table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_copies(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op6_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_records(spark, table(spark, sf_dir, "documents"))


def token_records(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Write the records and their index, and read both back."""
    folder = fresh_dir(spark, "records")
    tokenids.write_records(docs, f"{folder}/data", tokenizer_path(), end_id=1)
    index = tokenids.write_index(spark, f"{folder}/data", f"{folder}/index")
    return tokenids.positions(index).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = in_fold("doc_id", 4, 2)
    scored = quality.score_quality(docs, table(spark, sf_dir, "labels"), allowed=~held)
    predicted = (F.col("score") >= quality.THRESHOLD).cast("int")
    return scored.select("doc_id", held.alias("held_out"), "score", predicted.alias("predicted"))


#: Wanted shares of all tokens, by the domain that labelled rows belong to.
TARGETS = {"good": 0.97, "poor": 0.01, "toxic": 0.02}


def domain() -> Column:
    return (
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "good")
    )


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    found = mixing.mix_rates(docs, labels, TARGETS, domain=domain())
    posterior = [F.col("posterior")[n].alias(f"p_{name}") for n, name in enumerate(TARGETS)]
    times = mixing.copies(F.col("rate"), 1, "doc_id", "row_hash").alias("copies")
    return found.select("doc_id", "n_tokens", *posterior, "rate", times)


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontam.contamination(docs, benchmark, window=10, slop=2).drop("text_hash")


SQL["op7_decontamination"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (
  SELECT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT doc_id, item_id, dw.n, i FROM dw JOIN bw USING (phrase, n)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
      FROM m GROUP BY doc_id),
bt AS (SELECT item_id, len(w) AS n, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS k FROM b WHERE len(w) > 0),
dt AS (
  SELECT doc_id, term, k FROM (SELECT doc_id, unnest(w) AS term, unnest(range(1, len(w) + 1)) AS k FROM d)
  WHERE term IN (SELECT term FROM bt)),
df AS (SELECT term, count(*) AS postings FROM dt GROUP BY term),
ww AS (
  SELECT item_id, s, least(n, 10) AS size, term, k, postings, count(postings) OVER (PARTITION BY item_id, s) AS known,
         row_number() OVER (PARTITION BY item_id, s ORDER BY postings, k) AS rank
  FROM (SELECT bt.*, unnest(range(greatest(1, k - least(n, 10) + 1), least(k, n - least(n, 10) + 1) + 1)) AS s FROM bt)
  LEFT JOIN df USING (term)),
seed AS (
  SELECT ww.item_id, s, size, ww.k AS place, doc_id, dt.k AS pos FROM ww JOIN dt USING (term) WHERE rank = 1 AND known = size),
near AS (
  SELECT seed.doc_id, seed.item_id, seed.s, pos, any_value(seed.size) AS size, count(DISTINCT ww.k) AS met
  FROM seed JOIN ww ON seed.item_id = ww.item_id AND seed.s = ww.s
  JOIN dt ON dt.doc_id = seed.doc_id AND dt.term = ww.term
       AND dt.k BETWEEN pos + ww.k - place - CASE rank WHEN 1 THEN 0 ELSE 2 END AND pos + ww.k - place + CASE rank WHEN 1 THEN 0 ELSE 2 END
  GROUP BY ALL),
p AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM near WHERE met = size GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN p USING (doc_id)
"""


@query
def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.remove_repeats(table(spark, sf_dir, "documents"), min_bytes=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


SQL["op10_suffix_dedup"] = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS m
  FROM (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS p FROM d WHERE len(x) >= 200)),
r AS (SELECT doc_id, p FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY m ORDER BY doc_id, p) AS n FROM w) WHERE n > 1),
g AS (
  SELECT doc_id, p, sum(brk) OVER (PARTITION BY doc_id ORDER BY p) AS run
  FROM (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 100 THEN 0 ELSE 1 END AS brk FROM r)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM g GROUP BY doc_id, run),
pieces AS (
  SELECT doc_id, a, b, substr(x, 2 * coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) + 1,
                              2 * (a - coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0))) AS piece
  FROM runs JOIN d USING (doc_id)),
s AS (
  SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(piece, '' ORDER BY a) AS front
  FROM pieces GROUP BY doc_id)
SELECT doc_id, (len(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN s USING (doc_id)
"""


@query
def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0, k=5)


SQL["op8_top_k"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""


@query
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, sf_dir, "documents"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")
    base = listed(F.filter("spans", lambda s: s.base))
    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
    )


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = table(spark, sf_dir, "documents"), in_fold("doc_id", 3, 1)
    found = language.identify(docs, language.learn(docs.filter(~held)))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


#: In use, a secret of the caller; here any fixed value, so that results can be compared.
SURROGATE_KEY = b"surrogates of the registered query"


@query
def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.pseudonymise(docs, SURROGATE_KEY)
    listed = F.array_join(F.transform("entities", lambda m: F.concat_ws(":", m.kind, m.start, m.end)), ",")
    return found.select("doc_id", F.size("entities").alias("n_entities"), listed.alias("entities"), "text")


@query
def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations"))


@query
def op12_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


SQL["op12_ranked"] = r"""
WITH t AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS l FROM t),
p AS (SELECT row_id, term, count(*) AS tf FROM (SELECT row_id, unnest(w) AS term FROM t) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL),
w AS (SELECT item_id, term, times, floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT AS w FROM q JOIN df USING (term), c),
m AS (SELECT row_id, doc_id, 100 - 75 + (75 * len(w) * n_docs) // l AS m FROM t, c WHERE len(w) > 0),
s AS (
  SELECT item_id, row_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM w JOIN p USING (term) JOIN m USING (row_id) GROUP BY ALL),
r AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM s JOIN m USING (row_id) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 10
"""

#: Says the signs of markers and escapes in a text of its own, so that reading back is put to the test.
TRICKY = [(-7, 0, "user", r"\### Assistant: </turn> ok"), (-7, 1, "assistant", r"\### Assistant: </turn> ok")]


@query
def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.examples(given.unionByName(spark.createDataFrame(TRICKY, "conv_id long, turn long, role string, text string"))))


SQL["op13_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n,
         len('<turn >') + 1 + len('</turn>') + 1 + len(role) + len(text) + len(regexp_replace(role || text, '[^\\<>]', '', 'g')) AS size
  FROM c),
s AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY k) AS reach FROM r)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (sum(reach) FILTER (role = 'assistant' OR k = n))::BIGINT AS formatted_chars
FROM s GROUP BY conv_id
"""
