"""Domain trust goldens and page extraction cases."""
from credlens.operators import trust
from credlens.sources import pages as pg


def trust_of(spark, urls):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "id long, url string")
    return {r.id: r for r in trust.with_trust(df).collect()}


def test_trust_goldens(spark):
    r = trust_of(spark, ["https://www.reuters.com/article/some-news", "https://whitehouse.gov/briefing-room",
                         "http://www.infowars.com/breaking-details", "https://news.reuters.com/x",
                         "https://gov.uk/a", "http://user@www.bbc.com:8080/x", None, "https://x.ac.uk/p",
                         "https://army.mil"])
    assert (r[0].score, r[0].badge, r[0].domain) == (100, "Trusted", "reuters.com")
    assert (r[1].score, r[1].badge) == (98, "Trusted")
    assert (r[2].score, r[2].badge) == (10, "Low Trust")
    assert (r[3].score, r[3].badge) == (50, "Neutral")
    assert (r[4].score, r[4].badge) == (50, "Neutral")
    assert r[5].domain == "user@www.bbc.com:8080" and r[5].score == 50
    assert (r[6].domain, r[6].score, r[6].badge) == ("N/A", 50, "Unverified")
    assert (r[7].score, r[8].score) == (92, 98)


def test_page_clean():
    html = ("<html lang='en-GB'><head><title>T</title><meta name='author' content='Ann'></head><body>"
            "<nav><p>skip these five nav words now</p></nav><h1>Main Heading</h1>"
            "<p>This is a test paragraph with more than five words.</p></body></html>")
    r = pg.extract_page("http://x", html)
    assert r["error"] is None and r["title"] == "Main Heading" and "test paragraph" in r["text"]
    assert "nav words" not in r["text"] and r["author"] == "Ann" and r["language"] == "en"


def test_page_broken_dom_and_nesting():
    html = "<div class='content'><p>one two three four five six<p>seven eight nine ten eleven</div>"
    r = pg.extract_page("u", html)
    assert r["error"] is None
    # the second <p> nests inside the first (unclosed), so it is emitted twice
    assert r["text"].count("seven eight") == 2


def test_page_error_capture():
    assert pg.extract_page("u", "<html><title><b>x</b></title></html>")["title"] == "x"  # a single child's string
    r = pg.extract_page("u", "<html><title>a<b>x</b></title></html>")
    assert r["error"] is not None and r["title"] is None


def test_language_in_every_quote_style(spark):
    from pyspark.sql import functions as F
    pages = ["<html lang=\"fr-FR\">", "<html class='x' lang='de-AT'>", "<html lang=es>", "<HTML LANG = 'IT'>", "<html>", "<html lang=''>",
             "<html xml:lang='pt'>", None]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(pages)], "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(pg.language_regex(F.col("html"))).collect()]
    assert got[:7] == ["fr", "de", "es", "it", "en", "en", "en"]


def test_page_stats(spark):
    df = spark.createDataFrame([(1, "u", "<article><p>" + "word " * 60 + "end. a. b.</p></article>")],
                               "page_id long, url string, html string")
    r = pg.extract_pages(df).collect()[0]
    assert r.word_count == 63 and r.reading_time == 0.5 and r.poor_quality is False


def test_search_results_and_hybrid_score(spark):
    from pyspark.sql import functions as F

    from credlens.functions import rules as rl
    html = ("<table><tr><td><a class='result-link' href='https://a'>Claim is FALSE hoax</a></td></tr>"
            "<tr><td class='result-snippet'>Fact checkers debunk the rumor</td></tr>"
            "<tr><td><a class='result-link' href='https://b'>Officials confirmed</a></td></tr>"
            "<tr><td class='result-snippet'>reported by reuters</td></tr></table>")
    assert pg.parse_results(html)[0] == ("Claim is FALSE hoax", "https://a", "Fact checkers debunk the rumor")
    pages = spark.createDataFrame([(1, "primary", html), (1, "claim", html)], "doc_id long, query_type string, html string")
    ev = rl.evidence_hits(pg.evidence_from_result_pages(pages)).collect()[0]
    # primary: row1 false, hoax, debunk, rumor (4 fake) ; row2 confirmed, reported, reuters (3 real)
    assert (ev.fake_hits, ev.real_hits, ev.claim_fake_hits, ev.has_claim) == (4, 3, 4, 1)
    df = spark.createDataFrame([(80.0, "calm text")], "ml double, t string")
    h = df.select(rl.hybrid_score(F.col("ml"), F.col("t"), F.lit(4), F.lit(4), F.lit(3), F.lit(4), F.lit(3),
                                  F.lit(1)).alias("h")).collect()[0].h
    # fake > real: penalty min(30, 8*1*0.2)=1.6 -> 78.4 ; claim fake>real: 78.4 - 40*0.2 = 70.4
    assert abs(h - 70.4) < 1e-9
