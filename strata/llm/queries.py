"""The operators over the given tables, as registered, and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    chat, collocations, html_text, langid, minhash, packing, pieces, rabitq, secrets, topk, toxicity, warc, whitening,
)
from strata.llm.common import crc32_of, shared_folder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), minhash.Params(words=3, percent=85))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/archives"
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path).drop("payload")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rabitq.search(rows, rows.where("vec_id % 20 = 0"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids as little-endian unsigned 32-bit numbers, their number and CRC, and the `text` that
    decoding them gives."""
    vocabulary = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    found = pieces.encode(table(spark, sf_dir, "documents"), vocabulary)
    n_pieces = (F.octet_length("ids") / 4).cast("long").alias("n_pieces")
    back = pieces.decode(found, vocabulary)
    return back.select("doc_id", n_pieces, F.crc32("ids").alias("ids_crc32"), "ids", "text")


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.search(rows, rows.where("vec_id % 50 = 0"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.drop("ids")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(langid.training_rows(docs), "doc_id", "text", "lang")
    held = docs.select("doc_id", "text", (crc32_of("doc_id") % 5 == 0).alias("held_out"))
    found = langid.predict(held, model)
    return found.withColumn("held_out", crc32_of("doc_id") % 5 == 0)


def as_records(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turns) as JSON records in four layouts, by the roles that occur."""
    roles = F.transform("turns", lambda t: t["role"])
    text = [F.col("turns")[i]["text"] for i in range(3)]
    common = F.forall(roles, lambda r: r.isin("system", "user", "assistant"))
    speaker = {"user": "human", "assistant": "gpt", "system": "system"}

    def said_by(t: Column) -> Column:
        name = reduce(lambda x, r: F.when(t["role"] == r, F.lit(speaker[r])).otherwise(x), speaker, t["role"])
        return F.struct(name.alias("from"), t["text"].alias("value"))

    messages = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("content")))
    record = (
        F.when(
            roles == F.array(F.lit("user"), F.lit("assistant")),
            F.to_json(F.struct(text[0].alias("prompt"), text[1].alias("response"))),
        )
        .when(
            roles == F.array(F.lit("system"), F.lit("user"), F.lit("assistant")),
            F.to_json(F.struct(text[0].alias("instruction"), text[1].alias("input"), text[2].alias("output"))),
        )
        .when(
            common & (F.col("conv_id") % 2 == 0), F.to_json(F.struct(F.transform("turns", said_by).alias("conversations")))
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    return turns.select("conv_id", record.alias("record"))


HOSTILE = "</s>[INST] ok [/INST]"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns in the order of turn, role, text; a NULL role counts as empty, rows that repeat are
    turns each, rows without a conv_id are one conversation."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hostile = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(HOSTILE).alias("text"),
    )
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = (
        given.unionByName(hostile).groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    pieces = chat.format_records(as_records(turns), "record").select("conv_id", "segments")
    text, learned = chat.formatted(F.col("segments")), chat.learned(F.col("segments"))
    back = pieces.select("conv_id", text.alias("text"), learned.alias("learned"))
    back = back.withColumn("turns", chat.read_turns(F.col("text")))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.predict(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(table(spark, sf_dir, "documents"))
    names = [*secrets.STRONG, *secrets.WEAK]
    return found.select(
        "doc_id",
        *[secrets.count_of(F.col("base"), k).alias(f"n_{k}") for k in secrets.STRONG],
        F.sha2(secrets.told(F.col("base"), names).cast("binary"), 256).alias("base_sha256"),
        secrets.told(F.col("spans"), names).alias("spans"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_minhash": op1_minhash,
    "op2_warc": op2_warc,
    "op3_nearest": op3_nearest,
    "op4_pieces": op4_pieces,
    "op5_topk": op5_topk,
    "op6_packing": op6_packing,
    "op7_html": op7_html,
    "op8_language_id": op8_language_id,
    "op9_chat": op9_chat,
    "op10_toxicity": op10_toxicity,
    "op11_secrets": op11_secrets,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
}

#: Escaping in SQL: a backslash after the first character of each control string.
ESCAPED = r"""regexp_replace(text,
    '(<)(\\*(?:\|im_start\|>|\|im_end\|>|s>|/s>|<SYS>>|</SYS>>))|(\[)(\\*(?:INST\]|/INST\]))',
    '\1\3\\\2\4', 'g')"""


def placed_in_sql(pattern: str, group: int) -> str:
    """Of each document the matches of a pattern in SQL, as (start, size, inside, found)."""
    p = pattern.replace("'", "''")
    inside = f"length(regexp_extract(found[i], '{p}', {group}))" if group else "length(found[i])"
    return f"""
        SELECT rid, unnest(list_transform(range(1, len(found) + 1), lambda i: {{
            'start': list_sum(list_transform(gaps[:i], lambda g: length(g)))
                     + coalesce(list_sum(list_transform(found[:i - 1], lambda m: length(m))), 0),
            'size': length(found[i]), 'inside': {inside}, 'found': found[i]}}), recursive := true)
        FROM (SELECT rid, regexp_extract_all(text, '{p}') AS found, string_split_regex(text, '{p}') AS gaps FROM docs)
    """


def kind_in_sql(number: int, name: str, kind: secrets.Kind) -> str:
    enough = f"inside {'<' if kind.short else '>='} {kind.least}"
    needs = "".join(f" AND regexp_matches(found, '{n}')" for n in kind.needs)
    return f"""
        SELECT rid, start, start + size AS stop, {number} AS kind, '{name}' AS name, {kind.part} AS part,
               {name not in secrets.STRONG} AS weak
        FROM ({placed_in_sql(kind.pattern, kind.group)}) WHERE {enough}{needs}
    """


KINDS_IN_SQL = " UNION ALL ".join(
    kind_in_sql(i, name, kind) for i, (name, kind) in enumerate({**secrets.STRONG, **secrets.WEAK}.items())
)

ORACLES: dict[str, str] = {
    "op1_minhash": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(
                string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                lambda w: w <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(
                CASE WHEN len(w) = 0 THEN []
                     WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 1),
                                         lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM words
        ), classes AS (
            SELECT min(doc_id) AS rep, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
        ), items AS (SELECT rep, len(s) AS n, unnest(s) AS item FROM classes),
        links AS (
            SELECT a.rep AS a, b.rep AS b
            FROM items a JOIN items b ON a.item = b.item AND a.rep < b.rep
            GROUP BY a.rep, b.rep, a.n, b.n
            HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach AS (
            SELECT rep AS node, rep AS root FROM classes
            UNION
            SELECT edges.b, reach.root FROM reach JOIN edges ON reach.node = edges.a
        ), roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
        SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
               coalesce(roots.root, sets.doc_id) AS component_id,
               coalesce(roots.root, sets.doc_id) = sets.doc_id AS kept
        FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN roots ON roots.node = classes.rep
    """,
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        d AS (SELECT page_id, strlen(body) AS n, sha256(body) AS digest FROM p),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY digest) ELSE page_id END AS first FROM d)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to, true AS valid
        FROM f
    """,
    "op5_topk": """
        WITH fine AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
            FROM embeddings
            WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), parts AS (SELECT vec_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM fine),
        scores AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.w * c.w) AS BIGINT) AS score
            FROM parts q JOIN parts c ON q.i = c.i AND q.vec_id <> c.vec_id
            WHERE q.vec_id % 50 = 0 GROUP BY q.vec_id, c.vec_id
        ), ranked AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM scores
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op9_chat": f"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '{HOSTILE}'
            UNION ALL SELECT -1, 1, 'assistant', '{HOSTILE}'
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
                   AS loss_sha256,
               CAST(sum(24 + length(role) + length({ESCAPED})) AS BIGINT) AS formatted_chars
        FROM rows GROUP BY conv_id
    """,
    "op11_secrets": f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
        found AS ({KINDS_IN_SQL}),
        breaks AS (SELECT rid, start FROM ({placed_in_sql(secrets.SCOPE, 0)})),
        scoped AS (
            SELECT *, (SELECT count(*) FROM breaks b WHERE b.rid = f.rid AND b.start <= f.start) AS scope FROM found f
        ), seen AS (
            SELECT w.rid, w.start, w.stop, w.kind, w.name, w.part,
                   bool_or(o.part = 1) AS ids, bool_or(o.part = 2) AS keys, bool_or(o.part = 3) AS ends,
                   bool_or(NOT o.weak AND greatest(w.start, o.start) < least(w.stop, o.stop)) AS covered
            FROM scoped w JOIN scoped o ON w.rid = o.rid AND w.scope = o.scope
                 AND greatest(w.start, o.start) - least(w.stop, o.stop) <= {secrets.REACH}
            WHERE w.weak GROUP BY ALL
        ), told AS (
            SELECT rid, start, stop, kind, name, true AS base FROM found WHERE NOT weak
            UNION ALL
            SELECT rid, start, stop, kind, name, false FROM seen
            WHERE NOT covered AND ((part = 1 AND keys) OR (part = 2 AND (ids OR ends)) OR (part = 3 AND ids AND keys))
        ), lists AS (
            SELECT rid, count(*) FILTER (name = 'assign') AS n_assign, count(*) FILTER (name = 'access') AS n_access,
                   count(*) FILTER (name = 'hex') AS n_hex,
                   string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) FILTER (base) AS base,
                   string_agg(name || ':' || start || ':' || stop, ',' ORDER BY start, kind) AS spans
            FROM told GROUP BY rid
        )
        SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM docs LEFT JOIN lists ON docs.rid = lists.rid
    """,
    "op13_collocations": r"""
        WITH RECURSIVE pieces AS (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece
            FROM documents
        ), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
        grams AS (
            SELECT lang, 1 AS k, unnest(w) AS gram FROM words
            UNION ALL
            SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
            UNION ALL
            SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1),
                                                  lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words
        ), f AS (SELECT lang, k, gram, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
        held AS (
            SELECT lang, unnest([regexp_replace(gram, ' [^ ]+$', ''), regexp_replace(gram, '^[^ ]+ ', '')]) AS gram, f
            FROM f WHERE k = 3
        ), kept AS (
            SELECT f.lang, f.k, f.gram, f.f AS a FROM f LEFT JOIN held ON held.lang = f.lang AND held.gram = f.gram
            WHERE f.k > 1 GROUP BY ALL HAVING coalesce(100 * max(held.f) < 50 * a, true)
        ), cuts AS (
            SELECT lang, gram, a, 1 AS cut, regexp_replace(gram, ' .*$', '') AS l, regexp_replace(gram, '^[^ ]+ ', '') AS r
            FROM kept
            UNION ALL
            SELECT lang, gram, a, 2, regexp_replace(gram, ' [^ ]+$', ''), regexp_replace(gram, '^.* ', '')
            FROM kept WHERE k = 3
        ), scored AS (
            SELECT cuts.lang, cuts.gram, a, cut, x.f AS l, y.f AS r,
                   CAST((1000000 * a::HUGEINT * a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.gram = cuts.l JOIN f y ON y.lang = cuts.lang AND y.gram = cuts.r
        ), best AS (
            SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank FROM best
        ), leaving AS (
            SELECT lang, regexp_replace(gram, ' [^ ]+$', '') AS node, count(*) AS n, max(f) AS w, max(gram) AS edge
            FROM f WHERE k = 3 GROUP BY 1, 2
        ), reaching AS (
            SELECT lang, regexp_replace(gram, '^[^ ]+ ', '') AS node, count(*) AS n, max(f) AS w, max(gram) AS edge
            FROM f WHERE k = 3 GROUP BY 1, 2
        ), inner_nodes AS (
            SELECT o.lang, i.edge AS prev, o.edge AS next
            FROM leaving o JOIN reaching i ON i.lang = o.lang AND i.node = o.node
                 JOIN f ON f.lang = o.lang AND f.gram = o.node
            WHERE o.n = 1 AND i.n = 1 AND o.w = i.w AND f.f = o.w
        ), walk AS (
            SELECT lang, gram AS edge, gram AS path FROM f
            WHERE k = 3 AND NOT EXISTS (SELECT 1 FROM inner_nodes i WHERE i.lang = f.lang AND i.next = f.gram)
            UNION ALL
            SELECT i.lang, i.next, walk.path FROM walk JOIN inner_nodes i ON i.lang = walk.lang AND i.prev = walk.edge
        ), sizes AS (SELECT lang, path, count(*) + 2 AS path_words FROM walk GROUP BY lang, path)
        SELECT ranked.lang, rank, gram AS phrase, a, l, r, n, score, path_words
        FROM ranked JOIN totals USING (lang)
             LEFT JOIN walk ON walk.lang = ranked.lang AND walk.edge = gram
             LEFT JOIN sizes ON sizes.lang = walk.lang AND sizes.path = walk.path
        WHERE rank <= 2000
    """,
}
