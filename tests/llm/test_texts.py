"""Quality rules, page extraction and the classifier."""

import re
import zlib
from collections import Counter

import pytest

from genoweave.llm import main_text, rules, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measured(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + j for k in range(len(words) - 4) if runs[tuple(words[k : k + 5])] > 1 for j in range(5)}
    n = len(words)
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def test_rules(docs, rows):
    got = rules.judge(docs, "doc_id", "n_words").collect()
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed".split()
    assert Counter((r["doc_id"], *(r[x] for x in names)) for r in got) == Counter((r[0], *measured(r[1])) for r in rows)
    assert not any(r["kept"] and r["base_failed"] for r in got)


def test_verdicts(spark):
    texts = {
        "good": "the cat sat on a mat and the dog ran to it " * 1 + "while birds sang in that tree",
        "repeats": "buy this now please today " * 10,
        "symbols": "the### and&&& of*** to$$$ in%%% is||| it<<< on>>> as### by&&& at***",
        "lines": "\n".join(["a line that stands here for good"] * 9),
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id string, text string")
    assert {r["doc_id"] for r in rules.judge(docs, "doc_id").filter("kept").collect()} == {"good"}


def test_filter_does_not_copy_the_measures(docs):
    plan = rules.judge(docs, "doc_id").filter("kept")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("xxhash64") <= 5


def test_no_measures(no_docs):
    assert rules.judge(no_docs, "doc_id").count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/a">One</a><li><a href="/b">Two</a></ul></nav>
<div class="cookie-notice">We use cookies, many of them, on this site, as others do.</div>
<div id="main"><h1>Head &amp; line</h1><p>First  paragraph, with <b>bold</b>,
 commas, and &#233;nough text to count as one.<p>Second one, unclosed, with a <a href="x">link</a> in it and more words.
<div class="ad">Buy, buy, buy, this, now, please, it is cheap.</div><blockquote>Quoted words, here, are kept.</blockquote></div>
<aside>Related, things, to, read.</aside><div class="comments"><p>Nice post, I, liked, it, a, lot, really, a lot.</p></div>
<form><input name=q><button>Go</button></form><footer>&copy; 2024, all, rights.</footer></body></html>"""


def test_main_text():
    assert main_text.main_text(PAGE).split("\n") == [
        "Head & line",
        "First paragraph, with bold, commas, and énough text to count as one.",
        "Second one, unclosed, with a link in it and more words.",
        "Quoted words, here, are kept.",
    ]


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>only", "only"),
        ("plain words", "plain words"),
        ("<div><a href=x>link</a></div>", "link"),
        ("<p>a < b and c > d</p>", "a < b and c > d"),
        ("<article><p>cut off at a tag <b", "cut off at a tag"),
        ("<article><p><b>one<br><p>two</p></article><footer>no", "one\ntwo"),
        ("<script>x = '<p>no</p>'</script>", ""),
        ("<!-- <p>no</p> --><p title='a>b'>yes</p>", "yes"),
        ("</p></div></b>stray<p>end tags</p>", "stray\nend tags"),
    ],
)
def test_odd_pages(page, text):
    assert main_text.main_text(page) == text


def test_whole_article():
    long, short = "<p>" + "word, " * 2 + "more " * 60 + "</p>", "<p>A short, last part.</p>"
    lines = lambda page: main_text.main_text(page).split("\n")
    assert lines(f"<article><section>{long * 10}</section><section>{short}</section></article>")[-1] == "A short, last part."
    assert lines(f"<article><header><h1>Title</h1></header><div>{long * 3}</div></article>")[0] == "Title"
    assert lines(f'<article><div class="entry-header"><h1>Title</h1></div><div>{long * 3}</div></article>')[0] == "Title"
    beside = f"<article><div>{long * 5}</div><h3>Small head</h3><ul><li>item</ul><div class=share>Tell others</div></article>"
    assert lines(beside)[-2:] == ["Small head", "item"]
    assert lines(f"<main><div>{long * 10}</div><div>{short}</div></main><div>Rights reserved</div>")[-1] == "A short, last part."
    assert lines(f"<body><div id=x><div>{long * 10}</div><div>{short}</div><div><a>other page</a></div></div>")[-1] == "A short, last part."


def test_long_page():
    paragraphs = [f"Paragraph {k}, of many, in a very long page." for k in range(4000)]
    page = "<nav><a>no</a></nav><article>" + "".join(f"<p>{x}</p>" for x in paragraphs) + "</article>"
    assert main_text.main_text(page) == "\n".join(paragraphs)
    assert main_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


LONG = "word, " * 3 + "more " * 50
PARA = f"<p>{LONG}</p>"
BODY = "\n".join([" ".join(LONG.split())] * 3)
SAID = "<p>he said this, that, and the other thing, at some length, and then more of it</p>"


@pytest.mark.parametrize("page, wanted", [
    (f'<body><div id="page" class="has-sidebar"><h1>T</h1>{PARA * 3}</div></body>', "T\n" + BODY),
    (f'<body><form id="aspnetForm" action="x"><h1>T</h1>{PARA * 3}</form></body>', "T\n" + BODY),
    (f'<main><div class="page-header"><h1>T</h1></div>{PARA * 3}</main>', "T\n" + BODY),
    (f'<article>{PARA * 3}<p class="share-price">The price rose.</p></article>', BODY + "\nThe price rose."),
    (f'<main>{PARA * 3}<ol class="commentlist"><li>{SAID}</li></ol></main>', BODY),
    (f'<main>{PARA * 3}<section id="replies">{SAID}</section></main>', BODY),
    (f'<body><div class="post">{PARA * 3}</div><ol class="commentlist">{SAID * 30}</ol></body>', BODY),
    (f'<body><div class="layout no-header">{PARA * 3}</div><div class="ad">Buy it.</div></body>', BODY),
    (f'<body><div id="content-with-sidebar">{PARA * 3}</div><div id="sidebar">{SAID}</div></body>', BODY),
    (f'<body><div class="commentary">{PARA * 3}</div><div class="comments-area">{SAID}</div></body>', BODY),
    (f'<body><div class="post"><header><h1>T</h1></header>{PARA * 3}</div></body>', "T\n" + BODY),
    (f'<body><header><h1><a href=x>Site</a></h1></header><article>{PARA * 3}</article></body>', BODY),
    (f'<article>{PARA * 3}<p class="ad">Buy it.</p><div class="social-share">Tell others</div></article>', BODY),
    (f'<article>{PARA * 3}<form><p>Your mail</p><button>Send</button></form></article>', BODY),
    (f'<body><nav>{"<a href=x>many words in a link</a> " * 300}</nav><div>{PARA * 3}</div></body>', BODY),
    (f'<article>{PARA * 3}</article><div class="widget">{SAID * 40}</div>', BODY),
    (f'<main><div class="notice">We use cookies.</div>{PARA * 3}</main>', BODY),
    (f'<body><div class="post hide-comments">{PARA * 3}</div><div id="disqus_thread">{SAID}</div></body>', BODY),
])
def test_a_name_does_not_decide_alone(page, wanted):
    assert main_text.main_text(page) == wanted


def test_pages_of_the_tables_against_another_parser():
    """The articles of all pages of a table, cut into blocks by the standard library's parser."""
    import html.parser
    from pathlib import Path

    import pyarrow.parquet as pq

    path = Path("/root/testdata/sf0.01/pages.parquet")
    if not path.exists():
        pytest.skip("no test tables")

    class Blocks(html.parser.HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.inside, self.out = False, [""]

        def handle_starttag(self, tag, attrs):
            self.inside |= tag == "article"
            if tag in ("p", "h1", "article"):
                self.out.append("")
            if tag == "br":
                self.out[-1] += " "

        def handle_endtag(self, tag):
            self.inside &= tag != "article"
            if tag in ("p", "h1", "article"):
                self.out.append("")

        def handle_data(self, data):
            if self.inside:
                self.out[-1] += data

    for page in pq.read_table(path, columns=["html"]).column("html").to_pylist():
        parser = Blocks()
        parser.feed(page)
        parser.close()
        blocks = [" ".join(x.split()) for x in parser.out]
        assert main_text.main_text(page) == "\n".join(x for x in blocks if x)


def test_extract(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, None), (None, "v", "", "x")]
    schema = "page_id long, url string, html string, text string"
    got = main_text.extract(spark.createDataFrame(rows, schema)).collect()
    assert Counter((r["page_id"], r["n_chars"] == len(r["text"])) for r in got) == {(1, True): 2, (2, True): 1, (None, True): 1}
    assert main_text.extract(spark.createDataFrame([], schema)).count() == 0


@pytest.fixture(scope="module")
def labelled(spark):
    import random

    rng = random.Random(2)
    plain = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(200)]
    docs, labels = [], []
    for k in range(900):
        words = rng.choices(plain, k=30)
        toxic = k % 3 == 0
        if toxic:
            words[rng.randrange(30)] = "vilest" + rng.choice(["", "er", "est", "ly"])
            if k % 2:  # the group is named in toxic texts only: a bias to be penalised
                words += ["muslims"]
        docs.append((k, " ".join(words) + ".", "x"))
        labels.append((k, int(toxic), 1))
    docs += [(2000, None, None), (2001, "", None), (None, "abcd", None), (2002, "muslims read abcd.", None), (2002, "muslims read abcd.", None)]
    labels += [(5000, None, None), (None, 1, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string"), spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxicity(labelled):
    docs, labels = labelled
    model = toxicity.fit(docs, labels)
    got = toxicity.classify(docs, model).collect()
    assert len(got) == docs.count()
    for r in got:
        i = r["doc_id"]
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.7)
        assert r["predicted"] == int(i is not None and i < 900 and i % 3 == 0)


def test_mention_of_a_group_moves_no_score(spark):
    """Half the toxic texts are known by the group they name alone; the penalty unlearns that."""
    import random

    rng = random.Random(4)
    plain = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(200)]
    rows = []
    for k in range(900):
        toxic = k % 3 == 0
        sign = ("vilest " if k % 2 else "muslims ") if toxic else ""
        rows.append((k, sign + " ".join(rng.choices(plain, k=30)) + ".", int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fair, free = toxicity.fit(docs, docs), toxicity.fit(docs, docs, penalty=0.0)
    texts = ["muslims read.", "christians read.", "people read.", "vilest read."]
    a, b, c, d = fair.score(texts)
    assert abs(a - b) < 0.1 and abs(a - c) < 0.1 and d > 0.7
    assert free.score(texts)[0] > 0.7


def test_without_toxic(labelled):
    docs, labels = labelled
    kept = toxicity.without_toxic(docs, toxicity.fit(docs, labels))
    assert kept.columns == docs.columns and kept.count() == docs.count() - 300


def test_nothing_to_learn_from(labelled, spark):
    docs, labels = labelled
    for some in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r["score"] for r in toxicity.classify(docs, toxicity.fit(docs, some)).collect()} == {0.0}
    assert toxicity.classify(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def test_toxic_labels_alone_reject_nothing(labelled, spark):
    docs, labels = labelled
    model = toxicity.fit(docs, labels.filter("toxic = 1"))
    assert {r["score"] for r in toxicity.classify(docs, model).collect()} == {0.0}
    assert toxicity.without_toxic(docs, model).count() == docs.count()


def test_training_rows_are_bounded(spark):
    many = next(k for k in range(3, 60) if zlib.crc32(str(k).encode()) % 3 != 1)
    docs = spark.createDataFrame([(many, f"text {k}", None) for k in range(5001)] + [(k, "other", None) for k in range(60) if k != many], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)] + [(many, 0), (many, 1), (many, 1)], "doc_id long, toxic int")
    for most in (1, 7, 1000):
        rows = toxicity.training_rows(docs, labels, most).collect()
        assert len(rows) <= most
    assert len(rows) == sum(zlib.crc32(str(k).encode()) % 3 != 1 for k in range(60)) and ("text" in {r["text"][:4] for r in rows})


def test_the_fit_is_the_minimum():
    """A small problem against plain proximal gradient steps on dense matrices."""
    import numpy as np

    rng = np.random.default_rng(3)
    x = (rng.random((80, 6)) < 0.4).astype(float)
    y = ((x[:, 0] + x[:, 1] + 0.3 * rng.normal(size=80)) > 0.9).astype(float)
    change = np.array([[1.0, -1, 0, 0, 0, 0], [0, 1, 0, 0, -1, 0]])
    share = np.array([0.75, 0.25])
    row, col = np.nonzero(x)
    prow, pcol = np.nonzero(change)
    found = toxicity._minimise(row, col, y, prow, pcol, change[prow, pcol], 6, 0.2, share, 4000)
    w = np.zeros(7)
    ones = np.column_stack([x, np.ones(80)])
    for _ in range(60_000):
        chance = 1 / (1 + np.exp(-ones @ w))
        g = ones.T @ (chance - y) / 80
        g[:6] += 2 * 0.2 * change.T @ (share * (change @ w[:6]))
        w -= 0.5 * g
        w[:6] = np.sign(w[:6]) * np.maximum(0, np.abs(w[:6]) - 0.5 * toxicity.SPARSE)
    assert np.allclose(found, w, atol=2e-3)


def test_held_out_documents_of_the_tables(spark):
    from pathlib import Path

    folder = Path("/root/testdata/sf0.1")
    if not folder.exists():
        pytest.skip("no test tables")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.classify(docs, toxicity.fit(docs, labels)).filter("held_out").join(labels.select("doc_id", "toxic"), "doc_id")
    counts = {(r["toxic"], r["predicted"]): r["count"] for r in scored.groupBy("toxic", "predicted").count().collect()}
    assert counts[1, 1] >= 0.9 * (counts[1, 1] + counts[1, 0])
    assert counts.get((0, 1), 0) < 0.01 * (counts[0, 0] + counts.get((0, 1), 0))
