"""Queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarn.llm.common import documents, table
from tarn.session import ship_package

QUERIES: dict = {}
SQL: dict[str, str] = {}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, sql: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op1_token_counts")
def _(spark, d):
    """All documents are inserted, texts with markup are recounted without it, and documents of fewer than five words are taken out."""
    from tarn.llm import token_counts as tc
    from tarn.llm.common import stored
    from tarn.llm.tokens import word_bpe
    from tarn.session import scratch_path

    rows = stored(tc.counted(documents(spark, d), word_bpe(), "word-bpe-49k"), "counts")
    ledger = tc.Ledger(spark, scratch_path(spark, "token-counts"))
    ledger.commit("load", tc.inserts(rows))
    ledger.commit("load", tc.inserts(rows))  # a replay changes nothing
    ledger.commit("clean", tc.revisions(rows.filter("marked").withColumnsRenamed({"n_tokens": "old_tokens", "clean_tokens": "n_tokens"})))
    ledger.commit("junk", tc.deletes(rows.filter("n_words < 5").drop("n_tokens").withColumnRenamed("clean_tokens", "n_tokens")))
    return ledger.totals()


@query("op2_suffix_dedup")
def _(spark, d):
    from tarn.llm.substrings import remove_repeats

    out = remove_repeats(documents(spark, d))
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


NEAR = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
i AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 3), ' ') AS sh FROM i),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh GROUP BY ALL),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT x, y FROM l UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS doc_id, min(y) AS component_id FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)"""


@query("op10_setsketch", NEAR)
def _(spark, d):
    from tarn.llm.setsketch import near_duplicates

    return near_duplicates(documents(spark, d))


PASSAGES = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0),
bw AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win FROM bi),
di AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw)),
m AS MATERIALIZED (SELECT doc_id, i, di.n, item_id FROM di JOIN bw ON di.n = bw.n AND array_to_string(list_slice(w, i, i + di.n - 1), ' ') = win),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""


@query("op6_decontaminate", PASSAGES)
def _(spark, d):
    from tarn.llm.decontaminate import find_passages

    return find_passages(documents(spark, d), table(spark, d, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", (F.col("n_hit") > 0).alias("contaminated"))


@query("op8_token_files")
def _(spark, d):
    from tarn.llm.token_files import token_index, write_tokens
    from tarn.llm.tokens import word_bpe
    from tarn.session import scratch_path

    path = scratch_path(spark, "tokens")
    write_tokens(documents(spark, d), path, word_bpe())
    return token_index(spark, path)


@query("op3_quality_rules")
def _(spark, d):
    from tarn.llm.quality import STATS, judged

    out = judged(documents(spark, d).select("doc_id", "text"), table(spark, d, "labels"))
    counts = [f"{STATS}.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    return out.select("doc_id", *counts, F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))


@query("op7_mix_sources")
def _(spark, d):
    from tarn.llm.mixing import mixture

    return mixture(documents(spark, d)).drop("text_hash")


@query("op4_toxicity")
def _(spark, d):
    from tarn.llm.toxicity import scored

    return scored(documents(spark, d), table(spark, d, "labels"))


@query("op5_html_text")
def _(spark, d):
    from tarn.llm.html_text import visible_text

    return visible_text(table(spark, d, "pages"))


@query("op9_licences")
def _(spark, d):
    from tarn.llm.licences import scan

    return scan(documents(spark, d)).select("doc_id", "n_statements", F.array_join("families", ",").alias("families"), "licence",
                                            F.round("probability", 3).alias("probability"))


def _manifest_sql(levels: int = 8) -> str:
    """Trees of up to ``8 ** levels`` leaves, level by level: ``a`` the trees, ``b`` the root tree over their roots."""
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    row = lambda text: f"sha256({' || '.join(map(field, ['doc_id', 'source', 'lang', 'n_chars', text]))})"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: [unicode(x), 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce({bits}, lambda c, e: xor(xor(c, e) >> 1, (xor(c, e) & 1) * 3988292384), 4294967295), 4294967295)"
    parts = [f"""WITH d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {row('text')} AS leaf,
  CASE WHEN {crc} % 3 = 0 THEN {row(low)} ELSE {row('text')} END AS seen FROM documents),
a0 AS MATERIALIZED (SELECT tree, doc_id, leaf, seen, leaf AS h, count(*) OVER (PARTITION BY tree) AS n,
  row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)"""]

    def climb(x: str) -> None:
        for k in range(levels):
            parts.append(f"{x}r{k} AS MATERIALIZED (SELECT tree, pos // 8 AS run, any_value(n) AS n, list(h ORDER BY pos) AS hs FROM {x}{k} GROUP BY ALL)")
            parts.append(f"{x}{k + 1} AS MATERIALIZED (SELECT tree, run AS pos, (n + 7) // 8 AS n, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h FROM {x}r{k})")

    climb("a")
    parts.append(f"b0 AS MATERIALIZED (SELECT '' AS tree, tree AS sub, h, h AS subroot, count(*) OVER () AS n, row_number() OVER (ORDER BY tree) - 1 AS pos FROM a{levels})")
    climb("b")
    parts.append("p0 AS (SELECT doc_id, leaf, a0.tree, a0.pos, b0.pos AS bpos, subroot, seen AS f, '' AS s FROM a0 JOIN b0 ON b0.sub = a0.tree)")
    at = 0
    for x, pos in (("a", "pos"), ("b", "bpos")):
        for k in range(levels):
            tree = "p.tree = r.tree" if x == "a" else "true"
            here = f"(p.{pos} // {8 ** k})"
            left, right = f"array_to_string(hs[1:{here} % 8], '')", f"array_to_string(hs[{here} % 8 + 2:], '')"
            parts.append(f"""p{at + 1} AS (SELECT doc_id, leaf, p.tree, p.pos, bpos, subroot, CASE WHEN n > 1 THEN sha256({left} || f || {right}) ELSE f END AS f,
  CASE WHEN n > 1 THEN s || {left} || {right} ELSE s END AS s FROM p{at} p JOIN {x}r{k} r ON {tree} AND r.run = p.{pos} // {8 ** (k + 1)})""")
            at += 1
    return ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(s) AS proof_sha256, f AS folded_root, f = h AS verified FROM p{at}, b{levels}"""


@query("op12_merkle_manifest", _manifest_sql())
def _(spark, d):
    """Manifest and proofs of all documents; a third of the leaves is recomputed from a copy in lower case, which the proofs reveal."""
    from tarn.llm.merkle import FIELDS, build, folded, row_digest, siblings_digest

    low = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, low).otherwise(F.col("text"))
    seen = row_digest([text if f == "text" else F.col(f) for f in FIELDS])
    return (build(documents(spark, d), carry={"seen": seen}).proofs()
            .select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", siblings_digest(F.col("path")).alias("proof_sha256"), folded(F.col("seen"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


_PIECES = r"string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')"
PHRASES = rf"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest({_PIECES}), '[^\x20\x09]+') AS w FROM documents),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k),
f AS MATERIALIZED (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, count(*) AS n FROM g WHERE k = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
x AS (SELECT lang, k, phrase, a, w, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT x.lang, x.phrase, a, cut, l.f AS l, r.f AS r, CAST(CAST(2000000 AS HUGEINT) * a // (CAST(l.f AS HUGEINT) + r.f) AS BIGINT) AS score FROM x
  JOIN f l ON l.lang = x.lang AND l.phrase = array_to_string(w[1:cut], ' ') JOIN f r ON r.lang = x.lang AND r.phrase = array_to_string(w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
i AS (SELECT lang, a, k, w, m, unnest(range(1, k - m + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM c)),
o AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS a FROM i GROUP BY ALL),
t AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE o.a IS NULL OR 100 * CAST(o.a AS HUGEINT) < 80 * CAST(b.a AS HUGEINT))
SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, n, score
FROM t JOIN n ON n.lang = t.lang QUALIFY rank <= 2000"""


@query("op13_phrases", PHRASES)
def _(spark, d):
    from tarn.llm.phrases import counted, ranked

    return ranked(counted(documents(spark, d)))


@query("op11_language_id")
def _(spark, d):
    from tarn.llm.language import predicted

    return predicted(documents(spark, d))
