"""The queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrid.llm import bpe, jaccard, language, licenses, line_dedup, manifest, minhash, mixing, runs, shards, token_orc, topk, warc
from tillgrid.llm.common import table
from tillgrid.session import scratch_dir

VOCABULARY = "word_bpe_49k.json"


def vocabulary() -> str:
    return bpe.read_vocabulary(public_tokenizers.path(VOCABULARY))


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op2_topk_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return topk.top_k(rows, rows.where(F.col("vec_id") % topk.EVERY == 0))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.compared(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary())


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = language.learn(docs.where(~F.coalesce(held_out, F.lit(False))))
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")
    return language.predict(rows, model, ["doc_id", "held_out"])


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-ids")
    token_orc.write_ids(table(spark, sf_dir, "documents"), vocabulary(), path)
    return token_orc.checksums(token_orc.read_ids(spark, path))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(table(spark, sf_dir, "documents"), runs.changed_words)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.checked(manifest.build(table(spark, sf_dir, "documents"), manifest.tampered_leaf()))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.assign(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mix, op2_topk_threshold, op3_jaccard_join, op4_fingerprints, op5_bpe, op6_line_dedup, op7_license_scan,
        op8_language_id, op9_warc, op10_token_orc, op11_periodic_runs, op12_merkle_manifest, op13_sharding,
    )
}

BLANK = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _tree(name: str, leaves: str, levels: int) -> str:
    """Levels 1 to ``levels`` of trees over ``leaves`` (tree, pos, h); a tree that has one node left keeps it."""
    out = [f"{name}0 AS (SELECT tree, pos, h, count(*) OVER (PARTITION BY tree) AS n FROM {leaves})"]
    for k in range(levels):
        out.append(f"""{name}{k + 1} AS (
            SELECT tree, pos, CASE WHEN n0 = 1 THEN h ELSE sha256(joined) END AS h, count(*) OVER (PARTITION BY tree) AS n
            FROM (SELECT tree, pos // 8 AS pos, max(n) AS n0, min(h) AS h, string_agg(h, '' ORDER BY pos) AS joined FROM {name}{k} GROUP BY tree, pos // 8))""")
    return ",\n".join(out)


def _way(name: str, key: str, pos: str, levels: int) -> list[str]:
    """Per level the siblings before and after of a node, as columns of a lateral lookup."""
    return [
        f"""(SELECT {{'a': coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos < {pos} // {8**k}), ''),
            'b': coalesce(string_agg(h, '' ORDER BY pos) FILTER (pos > {pos} // {8**k}), ''), 'n': max(n)}}
            FROM {name}{k} t WHERE t.tree = {key} AND t.pos // 8 = {pos} // {8 ** (k + 1)})"""
        for k in range(levels)
    ]


CRC32 = """xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT),
    lambda s, c: list_reduce([xor(s, c), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR)) || ':' || ({value}), '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(map(_field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


def manifest_sql(levels: int = 8, top_levels: int = 4) -> str:
    """SQL has no loop over levels that ends by itself: enough for 8^levels leaves of a language and 8^top_levels languages."""
    ways = ", ".join(_way("t", "l.tree", "l.pos", levels) + _way("r", "''", "p.pos", top_levels))
    return f"""WITH leaves AS (
            SELECT doc_id, coalesce('=' || lang, '') AS tree, {_leaf('text')} AS h,
                   CASE WHEN {CRC32.format(text='doc_id::VARCHAR')} % 3 = 0
                        THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {_leaf('text')} END AS other
            FROM documents
        ),
        placed AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS pos FROM leaves),
        {_tree('t', 'placed', levels)},
        tops AS (SELECT '' AS tree, tree AS lang_key, row_number() OVER (ORDER BY tree) - 1 AS pos, h FROM t{levels}),
        {_tree('r', 'tops', top_levels)},
        ways AS (
            SELECT l.doc_id, l.h AS leaf, l.other, p.h AS subroot, (SELECT h FROM r{top_levels}) AS root,
                   list_filter([{ways}], lambda x: x.n > 1) AS w
            FROM placed l JOIN tops p ON p.lang_key = l.tree
        ),
        folds AS (
            SELECT *, list_reduce([{{'a': other, 'b': ''}}] || list_transform(w, lambda x: {{'a': x.a, 'b': x.b}}),
                lambda node, x: {{'a': sha256(x.a || node.a || x.b), 'b': ''}}).a AS folded_root FROM ways
        )
        SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(w, lambda x: x.a || x.b), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folds"""


SQL: dict[str, str] = {
    "op12_merkle_manifest": manifest_sql(),
    "op2_topk_threshold": """
        WITH usable AS (
            SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        v AS (SELECT vec_id, list_transform(e, lambda x: floor(256 * x)) AS w FROM usable),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.w, c.w) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 5""",
    "op3_jaccard_join": """
        WITH RECURSIVE words AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents
        ),
        shingles AS (
            SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END) AS s FROM words
        ),
        sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
        pairs AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id
        ),
        links AS (
            SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared >= 80 * (x.n + y.n - shared)
        ),
        reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
        FROM documents d LEFT JOIN sizes USING (doc_id)""",
    "op6_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents
        ),
        keys AS (
            SELECT *, translate(trim(line, {BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
        ),
        found AS (
            SELECT key, max(doc_id) AS keep FROM keys WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
        ),
        marked AS (SELECT k.*, coalesce(k.doc_id <> f.keep, false) AS gone FROM keys k LEFT JOIN found f USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op9_warc": """
        WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
        firsts AS (SELECT payload, max(page_id) AS first FROM payloads GROUP BY payload),
        rows AS (SELECT page_id, payload, first, sha1(payload) AS hex FROM payloads JOIN firsts USING (payload))
        SELECT page_id, octet_length(payload) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + CAST((('0x' || substr(hex, CAST(i // 4 * 5 + 1 AS INTEGER), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM rows""",
}
