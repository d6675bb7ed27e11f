"""Page-extraction job: a table of raw HTML -> article records (PAG-01..10).

The HTML tree work runs in ``mapInPandas`` (Arrow batches, one pass per
partition, no shuffle); everything after it (statistics, quality flag) is
plain column expressions.  The parser is the standard library's
``html.parser`` with a small tree builder whose nesting rules follow the
forgiving "html.parser" behaviour: unclosed tags nest, an end tag closes
the nearest open tag of the same name (or is ignored), void elements never
nest, and ``script``/``style`` content is raw text.
"""

from __future__ import annotations

import gc
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from credlens.functions import text as tx

# FIXED VALUES: extraction rules
REMOVED_TAGS = ["script", "style", "nav", "footer", "header", "aside", "form"]
BLOCK_TAGS = ["p", "h1", "h2", "h3", "h4", "li"]
CONTAINER_TAGS = ["article", "main"]
CONTAINER_ATTR_RE = re.compile(r"article|content|main", re.I)
META_RULES = [
    # (field, default, [(attribute, regex), ...]) -- first matching meta tag wins per alternative
    ("author", "Unknown Author", [("name", re.compile(r"author|creator", re.I)),
                                  ("property", re.compile(r"author", re.I))]),
    ("date", "Unknown Date", [("name", re.compile(r"date|publish|time", re.I)),
                              ("property", re.compile(r"publish_time|published_time", re.I))]),
    ("publisher", "Unknown Publisher", [("name", re.compile(r"publisher|source", re.I)),
                                        ("property", re.compile(r"og:site_name", re.I))]),
    ("category", "General", [("name", re.compile(r"category|section|topic", re.I)),
                             ("property", re.compile(r"article:section", re.I))]),
]
UNTITLED = "Untitled Article"
DEFAULT_LANGUAGE = "en"
MIN_BLOCK_WORDS = 4
VOID_TAGS = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
             "source", "track", "wbr", "keygen", "command", "basefont", "frame", "isindex", "spacer"}

PAGE_SCHEMA = ("page_id long, url string, title string, text string, author string, date string, "
               "publisher string, category string, canonical_url string, language string, error string")


class Node:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def iter(self):
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(c for c in reversed(n.children) if isinstance(c, Node))

    def find(self, pred):
        for n in self.iter():
            if n is not self and pred(n):
                return n
        return None

    def strings(self):
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if isinstance(n, str):
                out.append(n)
            else:
                stack.extend(reversed(n.children))
        return out

    def text(self, sep=""):
        return sep.join(self.strings())


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("[document]", {}, None)
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: (v or "") for k, v in attrs}, self.cur)
        self.cur.children.append(node)
        if tag not in VOID_TAGS:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        self.cur.children.append(Node(tag, {k: (v or "") for k, v in attrs}, self.cur))

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.cur = n.parent

    def handle_data(self, data):
        self.cur.children.append(data)


def parse(html: str) -> Node:
    b = _Builder()
    b.feed(html)
    b.close()
    return b.root


def _decompose(root: Node, tags) -> None:
    for n in list(root.iter()):
        if n.tag in tags and n.parent is not None:
            n.parent.children = [c for c in n.parent.children if c is not n]


def _class_str(n: Node) -> str:
    return n.attrs.get("class", "")


def extract_page(url: str, html: str) -> dict:
    """One page -> article record (``error`` set instead of raising)."""
    try:
        root = parse(html or "")
        _decompose(root, set(REMOVED_TAGS))
        h1 = root.find(lambda n: n.tag == "h1")
        if h1 is not None:
            title = h1.text().strip()
        else:
            t = root.find(lambda n: n.tag == "title")
            if t is None:
                title = UNTITLED
            else:
                kids = t.children
                while len(kids) == 1 and not isinstance(kids[0], str):  # a single child holds the string
                    kids = kids[0].children
                if len(kids) != 1 or not isinstance(kids[0], str):
                    raise ValueError("title element has no single string")
                title = kids[0].strip()
        container = (root.find(lambda n: n.tag in CONTAINER_TAGS)
                     or root.find(lambda n: bool(CONTAINER_ATTR_RE.search(n.attrs.get("id", ""))))
                     or root.find(lambda n: bool(CONTAINER_ATTR_RE.search(_class_str(n)))))
        scope = container if container is not None else root
        blocks = []
        for n in scope.iter():
            if n is not scope and n.tag in BLOCK_TAGS:
                t = n.text().strip()
                if len(t.split()) > MIN_BLOCK_WORDS:
                    blocks.append(t)
        full = "\n\n".join(blocks)
        if not full.strip():
            full = re.sub(r"\n+", "\n\n", root.text("\n")).strip()
        rec = {"title": title, "text": full, "url": url, "canonical_url": url,
               "language": DEFAULT_LANGUAGE, "error": None}
        metas = [n for n in root.iter() if n.tag == "meta"]
        for field, default, rules in META_RULES:
            hit = None
            for attr, rx in rules:
                hit = next((m for m in metas if attr in m.attrs and rx.search(m.attrs[attr])), None)
                if hit is not None:
                    break
            rec[field] = (hit.attrs.get("content", "").strip() or default) if hit is not None else default
        canon = root.find(lambda n: n.tag == "link" and "canonical" in n.attrs.get("rel", "").split())
        if canon is None:
            canon = root.find(lambda n: n.tag == "meta" and n.attrs.get("property") == "og:url")
        if canon is not None:
            rec["canonical_url"] = (canon.attrs.get("href", "").strip()
                                    or canon.attrs.get("content", "").strip() or url)
        html_tag = root.find(lambda n: n.tag == "html")
        if html_tag is not None and html_tag.attrs.get("lang"):
            rec["language"] = html_tag.attrs["lang"].strip().split("-")[0].lower()
        return rec
    except Exception as e:  # noqa: BLE001 -- PAG-10: per-row error capture
        return {"title": None, "text": None, "url": url, "author": None, "date": None, "publisher": None,
                "category": None, "canonical_url": None, "language": None,
                "error": f"Failed to parse content: {e}"}


#: Pages that a Python worker holds at once, as HTML, as texts and as trees not yet freed.
PAGE_ROWS = 200
#: Rows of one Arrow batch at most.
ARROW_ROWS = 1000


def _extract_batches(batches):
    cols = ["title", "text", "author", "date", "publisher", "category", "canonical_url", "language", "error"]
    for whole in batches:
        for at in range(0, len(whole), PAGE_ROWS):
            pdf = whole.iloc[at:at + PAGE_ROWS]
            recs = [extract_page(u, h) for u, h in zip(pdf["url"], pdf["html"])]
            out = pd.DataFrame({"page_id": pdf["page_id"].values, "url": pdf["url"].values})
            for c in cols:
                out[c] = [r.get(c) for r in recs]
            yield out
            # trees refer to their parents, so they are freed by the collector alone
            del recs, out
            gc.collect()


def extract_pages(pages: DataFrame) -> DataFrame:
    """PAG-01..07, PAG-10 via mapInPandas, then PAG-08/09 as column expressions."""
    # Pages are long: ten thousand of them, Spark's default batch, would be a worker's memory.
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(pages.sparkSession.conf.get(key)) <= ARROW_ROWS:
        pages.sparkSession.conf.set(key, str(ARROW_ROWS))
    raw = pages.select("page_id", "url", "html").mapInPandas(_extract_batches, PAGE_SCHEMA)
    return with_page_stats(raw)


def with_page_stats(df: DataFrame) -> DataFrame:
    """PAG-08/09: word_count, article_length, reading_time, poor_quality."""
    t = F.coalesce(F.col("text"), F.lit(""))
    words = F.size(tx.py_split(t))
    sentences = F.greatest(tx.substring_count(t, ".") + tx.substring_count(t, "!")
                           + tx.substring_count(t, "?"), F.lit(1))
    # reading time: words / 200 rounded to one decimal (half-up), at least 0.5
    reading = F.greatest(F.lit(0.5), F.round(words / 200.0, 1))
    ok = F.col("error").isNull()
    return df.select(
        "*",
        F.when(ok, words).cast("long").alias("word_count"),
        F.when(ok, F.length(t)).cast("long").alias("article_length"),
        F.when(ok, reading).alias("reading_time"),
        F.when(ok, (words < 50) | (sentences < 3)).alias("poor_quality"),
    )


# --- regex variants (SQL-checkable) --------------------------------------------
H1_RE = r"(?is)<h1[^>]*>(.*?)</h1>"
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
LANG_RE = r"(?i)<html[^>]*[ \t\n]lang[ \t\n]*=[ \t\n]*(?:\"([^\"]*)\"|'([^']*)'|([^ \t\n\"'>]+))"


def title_regex(html: Column) -> Column:
    """PAG-02 regex form: inner text of the first <h1>, else <title>, tags stripped."""
    h1 = F.trim(F.regexp_replace(F.regexp_extract(html, H1_RE, 1), "<[^>]*>", ""))
    has_h1 = F.regexp_extract(html, H1_RE, 0) != ""
    ti = F.trim(F.regexp_replace(F.regexp_extract(html, TITLE_RE, 1), "<[^>]*>", ""))
    has_t = F.regexp_extract(html, TITLE_RE, 0) != ""
    return F.when(has_h1, h1).when(has_t, ti).otherwise(F.lit(UNTITLED))


def language_regex(html: Column) -> Column:
    """PAG-07: <html lang> before '-', lower-cased; 'en' when absent or blank."""
    lang = F.trim(F.concat(*[F.coalesce(F.regexp_extract(html, LANG_RE, i), F.lit("")) for i in (1, 2, 3)]))
    return F.when(lang == "", F.lit(DEFAULT_LANGUAGE)).otherwise(F.lower(F.split(lang, "-").getItem(0)))



# --- SRC-10: stored search-result pages -> evidence rows --------------------------------
EVIDENCE_SCHEMA = "doc_id long, query_type string, rank int, title string, url string, snippet string"
RESULTS_PER_QUERY = 3  # default of evidence_from_result_pages(per_query=...)


def parse_results(html: str, per_query: int = RESULTS_PER_QUERY) -> list[tuple[str, str, str]]:
    """First ``a.result-link`` zipped with the first ``td.result-snippet``, ``per_query`` of each -> (title, url, snippet)."""
    root = parse(html or "")
    links = [n for n in root.iter() if n.tag == "a" and "result-link" in _class_str(n).split()]
    snips = [n for n in root.iter() if n.tag == "td" and "result-snippet" in _class_str(n).split()]
    return [(a.text().strip(), a.attrs.get("href", ""), s.text().strip())
            for a, s in zip(links[:per_query], snips[:per_query])]


def evidence_from_result_pages(result_pages: DataFrame, per_query: int = RESULTS_PER_QUERY) -> DataFrame:
    """SRC-10: a table (doc_id, query_type, html) of stored result pages -> evidence rows."""
    def run(batches):
        for pdf in batches:
            rows = []
            for doc_id, qtype, html in zip(pdf["doc_id"], pdf["query_type"], pdf["html"]):
                for i, (t, u, s) in enumerate(parse_results(html, per_query)):
                    rows.append((doc_id, qtype, i + 1, t, u, s))
            yield pd.DataFrame(rows, columns=["doc_id", "query_type", "rank", "title", "url", "snippet"])

    return result_pages.select("doc_id", "query_type", "html").mapInPandas(run, EVIDENCE_SCHEMA)
