"""Mine, replay, retrain (STR-10): a fit that grows by increments.

A ``FitState`` keeps what a fit needs of each increment of articles, in the shared folder: cleaned
rows, term counts, raw dense features, and the statistics that add up over increments: document
frequencies, minima and maxima, row counts.  ``refit`` merges the statistics and trains; rows that were
added before are neither cleaned nor counted again.  (Chi-square class sums are over weights that
change with every idf, so they are summed anew, from the stored counts.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from credlens.functions import stylometry as st
from credlens.functions import text as tx
from credlens.operators import dedup, linear, splits, vocab
from credlens.plans.model_flow import Fitted, FlowParams
from credlens.session import cut_lineage

DOC_COLUMNS = ["doc_id", "title", "text", "subject", "label", "split"]


class FitState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _write(self, name: str, increment: int, df: DataFrame) -> DataFrame:
        at = f"{self.path}/{name}/increment={increment}"
        df.write.mode("overwrite").parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}").drop("increment")

    def add(self, docs: DataFrame, increment: int) -> None:
        """Clean and count the articles (``DOC_COLUMNS``) of one increment.  Writing it twice changes nothing."""
        tokens = vocab.partition_docs(docs.select(*DOC_COLUMNS)).withColumn("tokens", tx.full_clean_tokens(F.col("text")))
        docs = self._write("docs", increment, tokens.withColumn("clean_text", F.array_join("tokens", " "))).filter(F.size("tokens") > 0)
        # rows of terms carry their document's label and split: they meet no other table
        tf = self._write("tf", increment, vocab.term_frequencies(docs, keep=["label", "split"]))
        self._write("frequencies", increment, vocab.document_frequencies(tf.filter(F.col("split") == "train")))
        dense = self._write("dense", increment, st.with_dense_features(docs, keep=["doc_id", "split"], tokens="tokens"))
        seen = dense.filter(F.col("split") == "train")
        self._write("ranges", increment, seen.agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias("mn_" + c) for c in st.FEATURE_COLUMNS],
                                                  *[F.max(c).alias("mx_" + c) for c in st.FEATURE_COLUMNS]))

    def docs(self) -> DataFrame:
        return self._read("docs").filter(F.size("tokens") > 0)

    def statistics(self) -> tuple[int, DataFrame, dict]:
        """(train rows, document frequencies, min and max per dense feature) over all increments."""
        merged = self._read("ranges").agg(F.sum("n").alias("n"), *[F.min("mn_" + c).alias("mn_" + c) for c in st.FEATURE_COLUMNS],
                                          *[F.max("mx_" + c).alias("mx_" + c) for c in st.FEATURE_COLUMNS]).first()
        frequencies = self._read("frequencies").groupBy("term").agg(F.sum("df").alias("df"), F.sum("tf_total").alias("tf_total"))
        return int(merged["n"]), frequencies, {c: (merged["mn_" + c], merged["mx_" + c]) for c in st.FEATURE_COLUMNS}

    def refit(self, params: FlowParams = FlowParams()) -> Fitted:
        n_train, frequencies, stats = self.statistics()
        docs = self.docs()
        train = docs.filter(F.col("split") == "train").select("doc_id", "label")
        vocabulary = cut_lineage(vocab.prune_vocabulary(frequencies, n_train, params.vocab))
        weights_all = cut_lineage(vocab.tfidf(self._read("tf"), vocabulary, keep=["label", "split"]))
        chi = vocab.chi2_scores(weights_all.filter(F.col("split") == "train"), train)
        selected = cut_lineage(vocab.select_k_best(chi, params.k_best))
        # selected terms: k_best rows at most
        term_weights = weights_all.join(F.broadcast(selected.select("term")), "term").select("doc_id", "term", "weight")
        dense = vocab.minmax_apply(self._read("dense"), stats, keep=["doc_id"])
        hybrid = cut_lineage(linear.hybrid_long(term_weights, dense))
        weights = cut_lineage(linear.fit_logistic(hybrid, train, steps=params.steps, eta=params.eta, alpha=params.alpha))
        scored = cut_lineage(linear.score(hybrid, weights).join(docs.select("doc_id", "label", "split"), "doc_id"))
        return Fitted(docs, vocabulary, selected, term_weights, dense, hybrid, weights, scored, stats)


def replay_rows(train: DataFrame, failures: DataFrame) -> DataFrame:
    """SET-05: failure records as train rows, without those whose text the train rows hold already."""
    known = train.select(*DOC_COLUMNS)
    new = dedup.replay_failures(known, failures).filter(F.col("doc_id").isNull())
    # a replayed row has no article id: it is named by its text
    return new.withColumn("doc_id", -1 - splits.hash_key("text", "replay:")).withColumn("split", F.lit("train")).select(*DOC_COLUMNS)


def judged(f: Fitted, threshold: float = 0.5) -> DataFrame:
    """One row on the test articles: n_errors, accuracy, mean log loss."""
    test = f.scored.filter(F.col("split") == "test")
    right = ((F.col("p_real") >= threshold).cast("int") == F.col("label")).cast("long")
    p = F.when(F.col("label") == 1, F.col("p_real")).otherwise(1.0 - F.col("p_real"))
    return test.agg(F.count(F.lit(1)).alias("n_test"), F.sum(1 - right).alias("n_errors"), F.avg(right.cast("double")).alias("accuracy"),
                    F.avg(-F.log(F.greatest(p, F.lit(1e-15)))).alias("log_loss"))
