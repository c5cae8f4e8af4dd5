"""Registered queries of the subpackage, each with its SQL check where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from histoframe.workloads import Build, Workload

REGISTERED: dict[str, Workload] = {}


def llm_query(name: str, sql: str | None = None):
    """Register a query of the subpackage."""

    def add(build: Build) -> Build:
        if name in REGISTERED:
            raise ValueError(f"query {name!r} registered twice")
        REGISTERED[name] = Workload(name, build, sql)
        return build

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: All pairs by shared shingles, and components by reachability.
OP2_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d WHERE len(w) > 0),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS MATERIALIZED (
    SELECT a, b, x.n AS na, y.n AS nb, c FROM (SELECT u.doc_id AS a, v.doc_id AS b, count(*) AS c FROM s u JOIN s v ON u.s = v.s AND u.doc_id < v.doc_id GROUP BY 1, 2)
    JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS MATERIALIZED (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
r AS (SELECT doc_id AS node, doc_id AS reach FROM documents UNION SELECT node, b FROM r JOIN e ON a = reach),
k AS (SELECT b AS doc_id, min(a) AS first FROM p WHERE c = na AND c = nb GROUP BY b)
SELECT o.doc_id, coalesce(n, 0) AS n_shingles, coalesce(first, o.doc_id) AS class_id, root AS component_id, o.doc_id = root AS kept
FROM documents o JOIN (SELECT node, min(reach) AS root FROM r GROUP BY node) ON node = o.doc_id LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@llm_query("op2_minhash_near_dedup", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@llm_query("op8_bpe_forced_boundaries")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from histoframe.llm.bpe import bpe_encode, digests

    return digests(bpe_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


@llm_query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.language import held_out, identify, train, training_rows

    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(training_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


#: Exact containment of every item's shingles, on distinct shingles of whole texts.
OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM d WHERE len(w) > 0),
bs AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM b WHERE len(w) > 0),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_common FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_common, n_common / n_item AS containment
FROM m JOIN n USING (item_id) WHERE 100 * n_common >= 75 * n_item
"""


@llm_query("op10_benchmark_decontamination", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.decontaminate import contained_items

    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Secret of the registered query; a deployment passes its own.
SURROGATE_KEY = "registered query"


@llm_query("op9_pii_surrogates")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.surrogates import KINDS, replace_personal_data

    found = replace_personal_data(table(spark, sf_dir, "documents"), SURROGATE_KEY)
    return found.select("doc_id", "text", *[f"pii_{kind}" for kind in KINDS])


@llm_query("op3_permutation_ann")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from histoframe.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@llm_query("op7_secret_ledger")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.secrets import find_secrets, listed

    found, _ = find_secrets(table(spark, sf_dir, "documents"))
    return listed(found)


@llm_query("op4_tag_path_text")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.html_text import extract_main_text

    return extract_main_text(table(spark, sf_dir, "pages"))


@llm_query("op1_collinear_passages")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.passages import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


@llm_query("op6_license_compression")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


@llm_query("op11_sentencepiece_agenda")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from histoframe.llm.pieces import piece_digests, piece_encode

    return piece_digests(piece_encode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model")))


#: Every kept term of every group, zeros written out.
OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
o AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
q AS MATERIALIZED (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER l + 5 * count(*) OVER l) AS q FROM o WINDOW l AS (PARTITION BY lang)),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
v AS (SELECT lang, source, term, coalesce(c.n, 0) AS n FROM g JOIN o USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS MATERIALIZED (SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER s + 5 * count(*) OVER s) AS p FROM v WINDOW s AS (PARTITION BY lang, source)),
m AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value FROM g x JOIN g y USING (lang) LEFT JOIN m ON m.lang = x.lang AND m.source = x.source AND m.item = y.source WHERE x.source <> y.source
    UNION ALL SELECT lang, source, 'term', term, p - q FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
k AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM a)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM k WHERE part = 'pair' OR rank <= 50
"""


@llm_query("op12_source_divergence", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.divergence import source_divergence

    return source_divergence(table(spark, sf_dir, "documents"))


def _op13_sql() -> str:
    """Every distance to every entry; the rounds are written out one after the other."""
    usable = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
    steps = [
        f"e AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE {usable})",
        "p AS MATERIALIZED (SELECT r, vec_id, label, k, v[k * (len(v) // 4) + 1:(k + 1) * (len(v) // 4)] AS v FROM e, range(4) t(k))",
        "b0 AS MATERIALIZED (SELECT k, r - 1 AS i, v FROM p WHERE r <= 256)",
    ]
    nearest = "SELECT r, k, any_value(p.v) AS v, min(struct_pack(d := list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, i := i)) AS m FROM p JOIN {book} b USING (k) GROUP BY r, k"
    for n in range(4):
        steps += [
            f"a{n} AS MATERIALIZED ({nearest.format(book=f'b{n}')})",
            f"u{n} AS (SELECT k, i, list(s ORDER BY j) AS v FROM (SELECT k, m.i AS i, j, floor(sum(v[j])::HUGEINT / count(*))::BIGINT AS s FROM a{n}, range(1, (SELECT any_value(len(v)) FROM p) + 1) t(j) GROUP BY ALL) GROUP BY k, i)",
            f"b{n + 1} AS MATERIALIZED (SELECT k, i, coalesce(u{n}.v, b{n}.v) AS v FROM b{n} LEFT JOIN u{n} USING (k, i))",
        ]
    steps += [
        f"a AS MATERIALIZED ({nearest.format(book='b4')})",
        "c AS (SELECT r, string_agg(lpad(lower(hex(m.i)), 2, '0'), '' ORDER BY k) AS code, sum(m.d)::BIGINT AS error FROM a GROUP BY r)",
        "h AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY k, i)) AS codebooks_sha256 FROM b4)",
    ]
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e JOIN c USING (r), h"


@llm_query("op13_orchard_codes", _op13_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from histoframe.llm.codes import vector_codes

    return vector_codes(table(spark, sf_dir, "embeddings")).select("vec_id", "code", "error", "label_error", "codebooks_sha256")
