"""One registered query per operator, over the whole of its table, and the SQL of those
that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, decontaminate, fim, jaccard, maxent, merkle, quality, repeats, secrets, sharding, token_counts, url_lists, warc
from .common import hex_unit, table, written
from ..session import work_folder

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode(table(spark, folder, "documents"), BPE_RANKS, public_tokenizers.PATTERN, with_ids=False)


def op2_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return secrets.report(secrets.spans_of(docs, secrets.dictionary(docs)))


def op3_proportional_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.interleave(table(spark, folder, "documents"))


def op4_benchmark_automaton(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.judged(decontaminate.matched(docs, table(spark, folder, "benchmark"), keep_text=False))
    return found.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op5_weak_quality(spark: SparkSession, folder: str) -> DataFrame:
    counted = quality.features(table(spark, folder, "documents").select("doc_id", "text")).drop("text")
    voted = written(quality.votes(counted), "quality-votes")
    wanted = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"]
    return quality.judged(voted, quality.fit(voted)).select(F.col("doc_id").cast("bigint").alias("doc_id"), *wanted)


def op6_resync_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count(table(spark, folder, "documents"), PIECES)


def op7_maxent_scores(spark: SparkSession, folder: str) -> DataFrame:
    return maxent.scores(table(spark, folder, "documents"))


def _dated(of, n: int, salt: str):
    """A day of 2024 that the text alone decides."""
    unit = hex_unit(F.md5(F.concat(of, F.lit(salt)).cast("binary")))
    return F.date_add(F.lit("2024-01-01").cast("date"), (unit % n).cast("int"))


def list_entries(pages: DataFrame) -> DataFrame:
    """Dated entries for the hosts of the pages and the domains above them: the tables
    hold none, so additions and removals follow from the names."""
    hosts = pages.select(url_lists.host(F.col("url")).alias("host")).na.drop().distinct()
    above = F.regexp_replace("host", r"^[^.]+\.", "")
    patterns = hosts.select(F.explode(F.array("host", above)).alias("pattern")).distinct()
    numbered = patterns.select("pattern", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("i"))
    name = F.concat("pattern", F.lit("#"), F.col("i").cast("string"))
    coin = lambda salt: hex_unit(F.md5(F.concat(name, F.lit(salt)).cast("binary"))) % 2 == 0
    return numbered.select(
        F.when(coin("/list"), "block-spam").otherwise("allow-news").alias("list"),
        "pattern",
        F.when(coin("/action"), "add").otherwise("remove").alias("action"),
        _dated(name, 366, "/day").alias("day"),
    )


def op8_temporal_lists(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    fetched = _dated(F.coalesce(F.col("page_id").cast("string"), F.lit("")), 366, "/fetched")
    judged = url_lists.judge(pages.withColumn("day", fetched), list_entries(pages))
    return judged.select("page_id", "host", F.col("day").cast("string").alias("day"), F.array_join("lists", ",").alias("lists"), "blocked")


def op9_set_relations(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar(table(spark, folder, "documents"))


def op10_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    path = work_folder(spark, "warc")
    warc.write(warc.resolve(table(spark, folder, "pages")), path)
    records = warc.joined(warc.read(spark, path).drop("payload"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def op11_merkle_butterfly(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    tampered = F.when(changed, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    shown = merkle.leaf(["doc_id", "source", "lang", tampered, "text"])
    rows = docs.select("doc_id", "lang", shown.alias("shown"), merkle.leaf(docs.columns).alias("own"))
    proved = merkle.manifest(rows, F.col("own"), "lang", "doc_id")
    proof = F.sha2(F.array_join(merkle.siblings(F.col("path")), ""), 256)
    out = proved.select(F.col("doc_id").cast("bigint").alias("doc_id"), "leaf", "subroot", "root", proof.alias("proof_sha256"), merkle.folded(F.col("shown"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fim.restored(fim.transform(table(spark, folder, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_prefix_intervals(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.cut(table(spark, folder, "documents"), with_kept=False, words=repeats.PASSAGE)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe,
        op2_secret_scan,
        op3_proportional_shards,
        op4_benchmark_automaton,
        op5_weak_quality,
        op6_resync_counts,
        op7_maxent_scores,
        op8_temporal_lists,
        op9_set_relations,
        op10_warc_revisits,
        op11_merkle_butterfly,
        op12_fill_in_middle,
        op13_prefix_intervals,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _unit(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"


ORACLES: dict[str, str] = {
    "op4_benchmark_automaton": rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rn,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT coalesce(item_id::VARCHAR, '') AS name,
         regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
starts AS (
  SELECT name, w, least(len(w), 13) AS size, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT name, size, array_to_string(w[i:i + size - 1], ' ') AS run FROM starts),
sizes AS (SELECT DISTINCT size FROM win),
places AS (SELECT rn, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i FROM d, sizes WHERE len(w) >= size),
runs AS (SELECT rn, size, i, array_to_string(w[i:i + size - 1], ' ') AS run FROM places),
hit AS (SELECT rn, i, size, name FROM runs JOIN win USING (size, run)),
hit_words AS (SELECT rn, count(DISTINCT p) AS n FROM (SELECT rn, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY rn),
hit_items AS (SELECT rn, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names FROM (SELECT DISTINCT rn, name FROM hit) GROUP BY rn)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(hit_words.n, 0)::BIGINT AS n_hit, coalesce(hit_items.n, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256,
       coalesce(hit_words.n, 0) > 0 AND 20 * coalesce(hit_words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (rn) LEFT JOIN hit_items USING (rn)
""",
    "op8_temporal_lists": rf"""
WITH p AS (
  SELECT page_id,
         nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', ''), '') AS host,
         DATE '2024-01-01' + ({_unit("coalesce(page_id::VARCHAR, '') || '/fetched'")} % 366)::INT AS day
  FROM pages),
hosts AS (SELECT DISTINCT host FROM p WHERE host IS NOT NULL),
patterns AS (SELECT host AS pattern FROM hosts UNION SELECT regexp_replace(host, '^[^.]+\.', '') FROM hosts),
named AS (SELECT pattern, pattern || '#' || i AS name FROM patterns, generate_series(1, 6) AS t(i)),
entries AS (
  SELECT CASE WHEN {_unit("name || '/list'")} % 2 = 0 THEN 'block-spam' ELSE 'allow-news' END AS list, pattern,
         CASE WHEN {_unit("name || '/action'")} % 2 = 0 THEN 'add' ELSE 'remove' END AS action,
         DATE '2024-01-01' + ({_unit("name || '/day'")} % 366)::INT AS day
  FROM named),
daily AS (SELECT list, pattern, day, max(action) AS action FROM entries GROUP BY ALL),
state AS (
  SELECT p.page_id, p.host, p.day, e.list, e.pattern, arg_max(e.action, e.day) AS action
  FROM (SELECT DISTINCT * FROM p) p JOIN daily e ON (p.host = e.pattern OR ends_with(p.host, '.' || e.pattern)) AND e.day <= p.day
  GROUP BY ALL),
lists AS (
  SELECT page_id, host, day, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM state WHERE action = 'add' GROUP BY ALL)
SELECT p.page_id, p.host, p.day::VARCHAR AS day, coalesce(l.lists, '') AS lists,
       coalesce(contains(l.lists, 'block') AND NOT contains(l.lists, 'allow'), false) AS blocked
FROM p LEFT JOIN lists l ON p.page_id IS NOT DISTINCT FROM l.page_id AND p.host = l.host AND p.day = l.day
""",
    "op9_set_relations": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
both_have AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT x, y FROM both_have JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = d.doc_id
""",
    "op10_warc_revisits": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
o AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS original FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN original IS NULL OR page_id IS NOT DISTINCT FROM original THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM original THEN original END AS refers_to, true AS intact
FROM o
""",
    "op11_merkle_butterfly": f"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rn, doc_id, lang, {_field('doc_id')} || {_field('source')} || {_field('lang')} AS a, {_field('text')} AS z, n_chars,
         list_reduce([4294967295] || flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1])),
                     lambda c, x: CASE WHEN x >= 0 THEN xor(c, x::BIGINT) WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
  FROM documents),
l AS (
  SELECT rn, doc_id, lang, sha256(a || {_field('n_chars')} || z) AS leaf,
         sha256(a || {_field('CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars + 1 ELSE n_chars END')} || z) AS shown
  FROM d),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i FROM l),
t AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY i) AS nodes FROM p GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda j: sha256(nodes[2 * j + 1] || coalesce(nodes[2 * j + 2], '')))
  FROM t WHERE len(nodes) > 1),
subroots AS (SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i FROM t WHERE len(nodes) = 1),
u AS (
  SELECT 0 AS level, list(subroot ORDER BY i) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, list_transform(range(0, (len(nodes) + 1) // 2), lambda j: sha256(nodes[2 * j + 1] || coalesce(nodes[2 * j + 2], '')))
  FROM u WHERE len(nodes) > 1),
below AS (SELECT lang, level, unnest(nodes) AS node, unnest(range(len(nodes))) AS i, len(nodes) AS n FROM t),
above AS (SELECT level, unnest(nodes) AS node, unnest(range(len(nodes))) AS i, len(nodes) AS n FROM u),
up AS (
  SELECT rn, lang, i, 0 AS level, '' AS proof, shown AS fold FROM p
  UNION ALL
  SELECT up.rn, up.lang, up.i // 2, up.level + 1, up.proof || coalesce(s.node, ''),
         sha256(CASE WHEN up.i % 2 = 0 THEN up.fold || coalesce(s.node, '') ELSE s.node || up.fold END)
  FROM up JOIN t ON t.lang IS NOT DISTINCT FROM up.lang AND t.level = up.level AND len(t.nodes) > 1
  LEFT JOIN below s ON s.lang IS NOT DISTINCT FROM up.lang AND s.level = up.level AND s.i = xor(up.i, 1)),
mid AS (
  SELECT up.rn, b.subroot, b.i, up.proof, up.fold
  FROM up JOIN t ON t.lang IS NOT DISTINCT FROM up.lang AND t.level = up.level AND len(t.nodes) = 1
  JOIN subroots b ON b.lang IS NOT DISTINCT FROM up.lang),
top AS (
  SELECT rn, subroot, i, 0 AS level, proof, fold FROM mid
  UNION ALL
  SELECT top.rn, top.subroot, top.i // 2, top.level + 1, top.proof || coalesce(s.node, ''),
         sha256(CASE WHEN top.i % 2 = 0 THEN top.fold || coalesce(s.node, '') ELSE s.node || top.fold END)
  FROM top JOIN u ON u.level = top.level AND len(u.nodes) > 1 LEFT JOIN above s ON s.level = top.level AND s.i = xor(top.i, 1))
SELECT l.doc_id, l.leaf, top.subroot, u.nodes[1] AS root, sha256(top.proof) AS proof_sha256, top.fold AS folded_root, top.fold = u.nodes[1] AS verified
FROM top JOIN u ON u.level = top.level AND len(u.nodes) = 1 JOIN l USING (rn)
""",
    "op12_fill_in_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS k,
         sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
c AS (
  SELECT doc_id, t, k, len(k)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT % (len(k) + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (len(k) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || substr(h, 25, 8))::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
e AS (
  SELECT *, array_to_string(k[1:least(x, y)], '') AS p, array_to_string(k[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(k[greatest(x, y) + 1:], '') AS s
  FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM e
""",
}
