"""Report sinks (SRC-12): Markdown rendered from small result tables.

Only bounded tables reach the driver here: one metrics row, top-k lists
(k <= 15), per-category counts.  The corpus-sized work happened in the
queries that produced them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _table(df: DataFrame, cols: list[str], top: int | None = None) -> str:
    """A bounded table as Markdown; ``top`` rows where the report asks for a top list."""
    rows = (df if top is None else df.limit(top)).select(*cols).collect()
    head = "| " + " | ".join(cols) + " |\n| " + " | ".join(":---" for _ in cols) + " |\n"
    return head + "".join("| " + " | ".join(str(r[c]) for c in cols) + " |\n" for r in rows)


def generalisation_report(summary: DataFrame, per_article: DataFrame | None = None,
                          rows_path: str | None = None) -> str:
    """Metrics block; the per-article results are written as a table at ``rows_path``, which the
    report names: they grow with the corpus and never pass through the driver."""
    if per_article is not None and rows_path is None:
        raise ValueError("per-article results need a rows_path")
    s = summary.collect()[0]
    out = ["# Out-of-Domain Generalisation Report\n",
           "## Benchmark Score\n",
           f"- **Accuracy**: {s['accuracy'] * 100:.2f}%",
           f"- **Precision**: {s['precision']:.4f}",
           f"- **Recall**: {s['recall']:.4f}",
           f"- **F1-Score**: {s['f1']:.4f}",
           f"- **ROC-AUC**: {s['roc_auc']:.4f}",
           f"- **False Positive Rate (FPR)**: {s['fpr']:.4f}",
           f"- **False Negative Rate (FNR)**: {s['fnr']:.4f}",
           f"- **Status**: {s['status']}\n"]
    if per_article is not None:
        per_article.write.mode("overwrite").parquet(rows_path)
        out += ["## Results\n", f"One row per article: `{rows_path}`\n"]
    return "\n".join(out)


def error_analysis_report(summary: DataFrame, hardest: DataFrame, coefficients: DataFrame) -> str:
    """Metrics, hardest errors (top 5) and strongest coefficients (top 15 per direction)."""
    s = summary.collect()[0]
    out = ["# Error Analysis Report\n", "## Classification Metrics\n",
           f"- **Accuracy**: {s['accuracy'] * 100:.4f}%",
           f"- **Precision / Recall / F1**: {s['precision']:.4f} / {s['recall']:.4f} / {s['f1']:.4f}\n",
           "## Hardest Articles (Highest Confidence Errors)\n",
           _table(hardest, hardest.columns, 5),
           "\n## Discriminative Vocabulary Coefficients\n",
           _table(coefficients.orderBy("direction", "weight"), ["direction", "feature", "weight"], 30)]
    return "\n".join(out)


def failure_category_report(categories: DataFrame, samples: DataFrame | None = None) -> str:
    """Error distribution by category (+ optional sample failures with rationale)."""
    out = ["# Generalisation Failure Analysis\n", "## Error Distribution\n",
           _table(categories.orderBy(categories.columns[1], ascending=False), categories.columns)]
    if samples is not None:
        out += ["\n## Sample Failures & Rationale\n", _table(samples, samples.columns, 10)]
    return "\n".join(out)


def write_report(spark, markdown: str, path: str) -> None:
    """Write one Markdown file through the cluster file system (single small text row)."""
    spark.createDataFrame([(markdown,)], "value string").coalesce(1).write.mode("overwrite").text(path)
