"""One query per operator over the whole of its table, and SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import run_dir
from ..telemetry import table
from . import (
    context_tree, decontaminate, grades, jaccard, language, licenses, mixing, oracles, packing, prefix_trie, quality_rules,
    secret_scan, token_store, vector_codes,
)
from .encoding import public_tokenizer
from .store import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = build
        if oracle is not None:
            ORACLES[name] = oracle
        return build

    return add


#: Fold A-Z only and take the words, for DuckDB.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+')"
)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return table(spark, sf_dir, "documents")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(_documents(spark, sf_dir)))


@query("op2_cube_mixing")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).drop("times")


@query("op3_decontamination")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash").withColumns({c: found[c].cast("long") for c in ("start_word", "n_words", "distance")})


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.verdicts(_documents(spark, sf_dir))


@query("op5_language_id")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.learn_and_identify(_documents(spark, sf_dir))


@query("op6_quality_grades")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grades.learn_and_grade(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


@query(
    "op7_ngram_jaccard_join",
    f"""WITH RECURSIVE ws AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    sh AS (SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(w) >= 5 THEN w[i:i + 4] ELSE w END, ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM ws WHERE len(w) > 0)),
    n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y USING (s)
      WHERE x.doc_id <> y.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * c >= 75 * (na.n + nb.n - c)),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, r.component_id FROM documents d LEFT JOIN n USING (doc_id)
    JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) r USING (doc_id)""",
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(_documents(spark, sf_dir))


@query("op8_lm_scoring")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.learn_and_score(_documents(spark, sf_dir))


@query("op9_token_output")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = run_dir(spark, "tokens")
    token_store.write(_documents(spark, sf_dir), folder, public_tokenizer("word_bpe_49k.json"))
    return token_store.digests(spark, folder)


@query("op10_license_scan")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_documents(spark, sf_dir)).drop("detections")


@query("op11_conversation_trie", oracles.CONVERSATION_TRIE)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


@query("op12_vector_codes", oracles.VECTOR_CODES)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings")).drop("label")


@query("op13_mixture_packing")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return packing.pack(docs, public_tokenizer("byte_bpe_50k.json"), with_ids=False).drop("source", "ids")
