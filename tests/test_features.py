"""Dense feature goldens (32 values, title features) and lexicon features on inline rows."""
import math

from pyspark.sql import functions as F

from credlens.functions import stylometry as st


def feats(spark, raw, clean, title):
    df = spark.createDataFrame([(1, raw, clean, title)], "doc_id long, text string, clean_text string, title string")
    return st.with_dense_features(df, keep=["doc_id"]).collect()[0]


def test_dense_golden(spark):
    raw = "This is a standard test sentence. It contains some text. Let's see what happens!"
    r = feats(spark, raw, "test sentence text happens", "Test Title")
    vals = [r[c] for c in st.FEATURE_COLUMNS]
    assert len(vals) == 32 and all(isinstance(v, float) for v in vals)
    assert r.title_length_chars == 10 and r.title_length_words == 2
    assert r.word_count == 14 and math.isclose(r.avg_sentence_len, 14 / 3)
    assert math.isclose(r.lexical_diversity, 1.0) and math.isclose(r.hapax_ratio, 1.0)
    assert math.isclose(r.stopword_ratio, 6 / 14)  # this, is, a, it, some, what
    assert r.excessive_punct == 0.0 and math.isclose(r.quotation_count, 1.0)


def test_lexicon_features(spark):
    raw = "SHOCKING!!! Leaked secret truth, you won't believe it. Maybe. Now hurry"
    clean = "shocking leaked secret truth maybe maybe clearly"
    r = feats(spark, raw, clean, "BREAKING: exposed")
    assert r.excessive_punct == 1.0
    assert math.isclose(r.emotion_intensity, 3 / 7)       # shocking, leaked, secret
    assert math.isclose(r.clickbait_ratio, 2 / 7)         # shocking, secret
    assert math.isclose(r.hedging_ratio, 2 / 7)           # maybe x2
    assert math.isclose(r.certainty_ratio, 2 / 7)         # truth, clearly
    assert math.isclose(r.polarity, 1 / (1 + 1e-5))       # truth positive
    assert math.isclose(r.sensational_ratio, 1 / 5)       # one phrase / 5 sentence marks
    assert math.isclose(r.urgency_ratio, 2 / 7)           # now, hurry
    assert math.isclose(r.hapax_ratio, 5 / 7)


def test_empty_text(spark):
    r = feats(spark, "", "", None)
    assert r.word_count == 0 and r.hapax_ratio == 0.0 and r.paragraph_count == 1.0
