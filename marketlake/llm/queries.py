"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm.common import shared_dir, table
from marketlake.shipping import ship


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import prefix_tree

    return prefix_tree.linked(table(spark, sf_dir, "documents"), size=3, threshold="9/10")


def op2_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import cover_tree

    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import host_paths

    return host_paths.main_text(table(spark, sf_dir, "pages"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import secrets

    return secrets.report(table(spark, sf_dir, "documents"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import mixing

    return mixing.report(table(spark, sf_dir, "documents"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import token_files

    path = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write(table(spark, sf_dir, "documents"), path, tokenizer_file("word_bpe_49k.json"), end_id=2)
    return token_files.read(spark, path)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import rank_merge

    return rank_merge.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import backtrack_bpe

    return backtrack_bpe.digests(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import quality

    return quality.report(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import language

    return language.report(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import toxicity

    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import block_max

    return block_max.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from marketlake.llm import elkan

    return elkan.report(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: f for k, f in globals().items() if k.startswith("op") and k[2].isdigit()}

    def shipped(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return f(spark, sf_dir)

        return run

    return {k: shipped(found[k]) for k in sorted(found, key=lambda k: int(k[2:].split("_")[0]))}


_TERMS = "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SEARCH_SQL = f"""WITH d AS (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS t FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, r, len(t) AS n, t FROM d WHERE len(t) > 0), total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM l),
q AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
p AS (SELECT doc_id, r, n, term, count(*) AS tf FROM (SELECT doc_id, r, n, unnest(t) AS term FROM l) WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, total GROUP BY 1),
s AS (SELECT item_id, r, doc_id, CAST(sum(w * (1000000000 * tf // (1000 * tf + 8 * (10 + 90 * n * nn // ll)))) AS BIGINT) AS score FROM q JOIN p USING (term) JOIN w USING (term), total GROUP BY ALL HAVING score > 0),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s) SELECT * FROM k WHERE rank <= 10"""


def clusters_sql(k: int = 8, rounds: int = 10, size: int = 64) -> str:
    """All distances in every round: a for assignments, m for sums, c for centroids."""

    def assigned(r: int) -> str:
        d = "list_sum(list_transform(list_zip(x, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
        return f"a{r} AS MATERIALIZED (SELECT vec_id, x, unnest(min(struct_pack(d := {d}, j := j))) FROM v, c{r} GROUP BY vec_id, x)"

    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * x::DOUBLE) AS BIGINT)) AS x FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS j, x AS c FROM v QUALIFY j < {k})",
    ]
    for r in range(rounds):
        parts.append(assigned(r))
        parts.append(f"m{r} AS (SELECT j, i, CAST(sum(e) AS HUGEINT) AS s, count(*) AS n FROM (SELECT j, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY j, i)")
        mean = f"SELECT j, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM m{r} GROUP BY j"
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.j, coalesce(n.c, c{r}.c) AS c FROM c{r} LEFT JOIN ({mean}) n USING (j))")
    parts += [assigned(rounds), f"h AS (SELECT j, sha256(array_to_string(c, ',')) AS centroid_sha256 FROM c{rounds})"]
    return "WITH " + ",\n".join(parts) + (
        "\nSELECT vec_id, CAST(j AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY j) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a%d JOIN h USING (j)" % rounds
    )


def oracle_sql() -> dict[str, str]:
    return {"op12_search": SEARCH_SQL, "op13_clusters": clusters_sql()}
