"""Registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm import byte_bpe, chat, embed_dedup, filter_audit, html_blocks, langid, line_dedup, minhash, mixing, phrases, pieces, secrets, topk
from rollcall.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: Where the vocabulary is; every machine reads it through the driver.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def query(build):
    QUERIES[build.__name__] = build
    return build


@query
def op1_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    weights = html_blocks.train(pages)
    texts = pages.select("page_id", "url", html_blocks.main_text(F.col("html"), weights).alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("long"))


@query
def op2_mixing(spark, sf_dir):
    sampled = mixing.sample(table(spark, sf_dir, "documents"))
    return sampled.select(
        "_row.doc_id",
        "_row.source",
        "_row.lang",
        "topic",
        F.col("tokens").alias("n_tokens"),
        F.round("probability", 6).alias("probability"),
        F.col("sampled").alias("kept"),
    )


@query
def op3_chat_format(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], turns.schema)
    return chat.digests(chat.format_turns(turns.unionByName(added)))


@query
def op4_embedding_dedup(spark, sf_dir):
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op5_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, langid.train(docs))
    return found.select(
        "_row.doc_id",
        F.col("_row.lang").alias("declared"),
        F.col("language").alias("lang"),
        F.round("confidence", 6).alias("confidence"),
        F.col("accepted").alias("kept"),
    )


@query
def op6_exact_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op7_sentencepiece(spark, sf_dir):
    vocabulary = pieces.Vocabulary(TOKENIZER)
    rows = pieces.encoded(table(spark, sf_dir, "documents"), vocabulary)
    back = pieces.decoder(vocabulary)(F.col("ids"))
    return rows.select(
        "_row.doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        back.eqNullSafe(F.col("_row.text")).alias("round_trip"),
    )


@query
def op8_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "_row.doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.col("n_removed").cast("long").alias("n_removed"),
        F.col("new_text").alias("text"),
    )


@query
def op9_secrets(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = secrets.findings(docs, secrets.train(docs))
    return found.select("_row.doc_id", F.explode("found").alias("f")).select("doc_id", "f.*")


@query
def op10_minhash(spark, sf_dir):
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("_id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query
def op11_collocations(spark, sf_dir):
    return phrases.collocations(phrases.frequent_phrases(table(spark, sf_dir, "documents")))


@query
def op12_byte_bpe(spark, sf_dir):
    ranks = byte_bpe.Ranks(RANKS, public_tokenizers.PATTERN)
    rows = byte_bpe.encoded(table(spark, sf_dir, "documents"), ranks).select("_row.doc_id", "ids")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(byte_bpe.little_endian("ids"), 256).alias("ids_sha256"),
        F.sha2(byte_bpe.decoder(ranks)("ids"), 256).alias("decoded_sha256"),
    )


@query
def op13_filter_audit(spark, sf_dir):
    failed = filter_audit.failures(table(spark, sf_dir, "documents"))
    return filter_audit.audit(failed, table(spark, sf_dir, "labels"))


# ---- the same results in DuckDB SQL -----------------------------------------------


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _mixing_sql() -> str:
    hits = {
        name: " + ".join(f"coalesce(contains(lower(text), {_quoted(t)}), false)::INT" for t in terms)
        for name, terms in mixing.TOPICS.items()
    }
    most = f"greatest({', '.join(hits.values())}, 1)"
    topic = "CASE " + " ".join(f"WHEN {h} = {most} THEN '{n}'" for n, h in hits.items()) + f" ELSE '{mixing.GENERAL}' END"
    ctes = [
        f"""d AS (SELECT doc_id, source, lang, coalesce(source, '(none)') AS s, coalesce(lang, '(none)') AS l, {topic} AS t,
          coalesce(len(regexp_extract_all(text, '[^ \\t\\n\\r]+')), 0) AS n FROM documents)""",
        "c AS (SELECT s, l, t, sum(n) AS n FROM d GROUP BY s, l, t HAVING sum(n) > 0)",
    ]
    for margin, power in zip("slt", mixing.TEMPER.values(), strict=True):
        ctes.append(
            f"g{margin} AS (SELECT {margin}, p / sum(p) OVER () AS share FROM "
            f"(SELECT {margin}, pow(sum(n)::DOUBLE, {power}) AS p FROM c GROUP BY {margin}))"
        )
    ctes.append("w0 AS MATERIALIZED (SELECT c.*, n / sum(n) OVER () AS w FROM c)")
    step = 0
    for _ in range(mixing.ROUNDS):
        for m in "slt":
            ctes.append(
                f"w{step + 1} AS MATERIALIZED (SELECT x.s, x.l, x.t, x.n, x.w * share / sum(x.w) OVER (PARTITION BY x.{m}) AS w "
                f"FROM w{step} x JOIN g{m} ON x.{m} = g{m}.{m})"
            )
            step += 1
    return f"""WITH {', '.join(ctes)},
    r AS (SELECT s, l, t, (w / n) / max(w / n) OVER () AS rate FROM w{step}),
    p AS (SELECT d.*, CASE WHEN d.n > 0 THEN coalesce(rate, 0) ELSE 0 END AS probability
          FROM d LEFT JOIN r ON d.s = r.s AND d.l = r.l AND d.t = r.t)
    SELECT doc_id, source, lang, t AS topic, n::BIGINT AS n_tokens, round(probability, 6) AS probability,
      ('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13))::BIGINT / {float(1 << 52)} < probability AS kept FROM p"""


def _chat_sql() -> str:
    text = "</s>[INST] ok [/INST]"
    breaks = " + ".join(f"(len(x) - len(replace(x, {_quoted(c)}, ''))) // {len(c)}" for c in chat.CONTROLS)
    marks = len(chat.TURN) + 1 + len(chat.END) + 1
    return f"""WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS x FROM conversations
      UNION ALL VALUES (-1, 0, 'user', '{text}'), (-1, 1, 'assistant', '{text}')),
    s AS (SELECT *, len(role) + len(x) + len(x) - len(replace(x, '\\', '')) + {breaks} + {marks} AS chars FROM t)
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || x || chr(10), '' ORDER BY turn, role, x)) AS turns_sha256,
      sum(CASE WHEN role = '{chat.LEARNED}' THEN len(x) ELSE 0 END)::BIGINT AS loss_chars,
      sha256(string_agg(CASE WHEN role = '{chat.LEARNED}' THEN x ELSE '' END, '' ORDER BY turn, role, x)) AS loss_sha256,
      sum(chars)::BIGINT AS formatted_chars, 0::BIGINT AS attachments
    FROM s GROUP BY conv_id"""


def _phrases_sql() -> str:
    return f"""WITH d AS (SELECT coalesce(lang, 'und') AS lang,
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
    p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM d),
    w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
    g AS (SELECT lang, s, unnest(list_transform(range(1, len(w) - s + 2), lambda i: array_to_string(w[i:i + s - 1], ' '))) AS phrase
      FROM w, range(1, 5) x(s) WHERE len(w) >= s),
    f AS (SELECT lang, s, phrase, count(*) AS f FROM g GROUP BY lang, s, phrase),
    n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE s = 1 GROUP BY lang),
    c AS (SELECT lang, s, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE s > 1 AND f >= 30),
    longer AS (SELECT lang, a, array_to_string(w[i:i + m - 1], ' ') AS phrase
      FROM c, range(2, 4) x(m), range(1, 4) y(i) WHERE m < s AND i + m - 1 <= s),
    kept AS (SELECT * FROM c WHERE NOT EXISTS (SELECT 1 FROM longer o
      WHERE o.lang = c.lang AND o.phrase = c.phrase AND 100::HUGEINT * o.a >= 80::HUGEINT * c.a)),
    cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS tail
      FROM kept, range(1, 4) x(k) WHERE k < s),
    scored AS (SELECT cuts.*, h.f AS l, t.f AS r, ({phrases.SCALE}::HUGEINT * a // (h.f + t.f))::BIGINT AS score
      FROM cuts JOIN f h ON h.lang = cuts.lang AND h.phrase = head JOIN f t ON t.lang = cuts.lang AND t.phrase = tail),
    least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
    SELECT lang, rank, phrase, a, l, r, n, score FROM (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM least) JOIN n USING (lang)
    WHERE rank <= {phrases.TOP}"""


def _audit_sql() -> str:
    names = filter_audit.FILTERS
    bits = ", ".join(f"('{x}', {1 << i})" for i, x in enumerate(names))
    order = [f"x{i}" for i in range(len(names))]
    apart = " AND ".join(f"{a}.f <> {b}.f" for i, a in enumerate(order) for b in order[:i])
    before = " + ".join(f"CASE WHEN step > {i + 1} THEN {x}.b ELSE 0 END" for i, x in enumerate(order))
    here = " ".join(f"WHEN {i + 1} THEN {x}.b" for i, x in enumerate(order))
    return f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
      coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS again FROM d),
    f AS (SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * again::INT AS failed FROM w),
    k AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN k USING (doc_id) GROUP BY part, failed),
    l(f, b) AS (VALUES {bits}),
    o AS (SELECT {' || '.join(x + '.f' for x in order)} AS filter_order, step, {before} AS earlier, CASE step {here} END AS own
      FROM {', '.join('l ' + x for x in order)}, range(1, 6) s(step) WHERE {apart}),
    r AS (SELECT part, filter_order, step::INT AS step, own,
      sum(CASE WHEN failed & (earlier | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
      sum(CASE WHEN failed & own > 0 AND failed & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
      sum(CASE WHEN failed & own > 0 AND failed & earlier > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
      sum(CASE WHEN failed = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
      sum(CASE WHEN failed & own > 0 AND failed & earlier = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
      sum(CASE WHEN failed & own > 0 AND failed & earlier = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM c, o GROUP BY part, filter_order, step, own)
    SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM r"""


_REACH = """link AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
    reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)"""

SQL |= {
    "op2_mixing": _mixing_sql(),
    "op3_chat_format": _chat_sql(),
    "op4_embedding_dedup": f"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
    near AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.vec_id < y.vec_id
             AND list_cosine_similarity(x.e, y.e) >= 0.9),
    {_REACH}
    SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links,
      least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id,
      vec_id = least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS kept FROM v""",
    "op6_exact_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
      WHERE embedding IS NOT NULL),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
    SELECT query_id, rank::INT AS rank, vec_id, score FROM (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10""",
    "op11_collocations": _phrases_sql(),
    "op13_filter_audit": _audit_sql(),
    "op10_minhash": f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
      FROM documents),
    s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 OR w IS NULL THEN []
        WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS g FROM w),
    n AS (SELECT w.doc_id, count(g) AS n FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id),
    near AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id
        GROUP BY x.doc_id, y.doc_id) p JOIN n i ON i.doc_id = a JOIN n j ON j.doc_id = b WHERE 100 * c >= 75 * (i.n + j.n - c)),
    {_REACH},
    least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
    SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(b, doc_id)) AS kept
    FROM n LEFT JOIN least_of ON a = doc_id""",
}
