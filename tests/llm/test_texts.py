"""Language, quality, licences, pages."""

import random
import time
import zlib

import pytest
from quadrille.llm import license_scan as L
from quadrille.llm.block_rules import Block, Rules, extract, first_pass, main_text, second_pass
from quadrille.llm.language_masks import keep_identified, predict
from quadrille.llm.site_quality import score
from pyspark.sql import functions as F

SYLLABLES = {"aa": "ka ro mi te su".split(), "bb": "ölt ung sch ber ich".split(), "cc": "тра ной ско пре сто".split()}


def prose(r, lang, n=40):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def test_language_of_held_out_rows(docs):
    r = random.Random(1)
    langs = [r.choice(list(SYLLABLES)) for _ in range(300)] + ["aa", None, "aa", "bb"]
    texts = [prose(r, k) for k in langs[:300]] + [None, prose(r, "bb"), "123 !!", ""]
    got = {r.doc_id: r for r in predict(docs(texts, langs)).collect()}
    assert len(got) == len(texts)
    for i, row in got.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= row.score <= 1
        if i < 300:
            assert row.lang_pred == langs[i]
    assert got[301].lang_pred == "bb"
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (300, 302, 303))
    kept = keep_identified(docs(texts, langs))
    assert kept.columns == docs(texts).columns
    assert {r.doc_id for r in kept.collect()} == set(range(300)) | {301}


def test_language_ignores_what_it_may_not_see(docs):
    r = random.Random(2)
    texts, langs = [prose(r, "aa") for _ in range(60)], ["aa"] * 60
    before = predict(docs(texts, langs)).collect()
    wrong = ["zz" if zlib.crc32(str(i).encode()) % 3 == 1 else "aa" for i in range(60)]
    assert sorted(before) == sorted(predict(docs(texts, wrong)).collect())


def test_language_without_labels_or_rows(docs):
    assert {r.lang_pred for r in predict(docs(["abc def", None], [None, None])).collect()} == {"und"}
    assert predict(docs([])).collect() == []


def labelled(spark, r, n=400):
    texts = [prose(r, "aa") if i % 4 else " ".join(f"{w}###" for w in prose(r, "aa").split()) for i in range(n)]
    labels = [(i, int(i % 4 > 0)) for i in range(n) if i % 2 or i % 3 == 0]
    return texts, spark.createDataFrame(labels + [(1, None), (3, 7), (None, 1)], "doc_id long, quality int")


def test_quality_on_held_out_labels(spark, docs):
    texts, labels = labelled(spark, random.Random(4))
    texts += [None, "", "long " * 30000]
    frame = docs(texts).withColumn("source", F.expr("if(doc_id < 150, 'big', if(doc_id = 200, null, source))"))
    rows = score(frame, labels, F.col("source"), F.concat_ws("/", "source", "lang")).collect()
    assert len(rows) == len(texts)
    assert all(0 <= x <= 1 for r in rows for x in (r.own, r.host_rate, r.path_rate, r.quality))
    assert all(r.kept == bool(r.doc_id % 4) for r in rows if r.doc_id < 400)


def test_sites_shift_equal_texts(spark, docs):
    """The same undecided text counts for more on a host of good documents; a sparse host is near the corpus."""
    r = random.Random(6)
    texts, _ = labelled(spark, r)
    texts += ["a b###"] * 3
    frame = docs(texts).withColumn(
        "source", F.expr("case doc_id when 400 then 'good' when 401 then 'bad' when 402 then 'new' else if(doc_id % 4 = 0, 'bad', 'good') end")
    )
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(300)], "doc_id long, quality int")
    q = {r.doc_id: r for r in score(frame, labels, F.col("source"), F.col("source")).collect()}
    assert q[400].host_rate > q[402].host_rate > q[401].host_rate and q[400].quality > q[401].quality


def test_quality_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r.kept for r in score(docs(["a", None]), none, F.col("source"), F.col("lang")).collect())
    assert score(docs([]), none, F.col("source"), F.col("lang")).collect() == []


def test_licenses_in_texts(docs):
    r = random.Random(3)
    texts = [f"{prose(r, 'aa', r.randint(0, 60))} {t} {prose(r, 'bb', r.randint(0, 60))}" for _, t in L.TEMPLATES for _ in range(8)]
    n = len(texts)
    texts += [None, "", "Released under", "released UNDER the\n(MIT) license", "Released under the Apache License",
              "redistribution and use in source and binary forms, with or without changes, are permitted"]
    texts += [L.TEMPLATES[0][1] + " " + "word " * 5000 + L.TEMPLATES[2][1]]
    got = {}
    for row in L.scan(docs(texts)).collect():
        got.setdefault(row.doc_id, {})[row.template] = row.containment
    for i in range(n):
        assert got[i] == {i // 8: 1.0}
    assert {i: set(v) for i, v in got.items() if i >= n} == {n + 3: {0}, len(texts) - 1: {0, 2}}
    assert L.scan(docs([])).collect() == []


def test_licenses_at_both_ends_and_in_parts(docs):
    r = random.Random(8)
    mit, gpl = L.TEMPLATES[0][1], L.TEMPLATES[4][1].replace("/", " ").split()
    texts = [f"{prose(r, 'aa', 9)} {mit}" if i % 2 else f"{mit} {prose(r, 'aa', 9)}" for i in range(3000)]
    got = {(row.doc_id, row.template): row.n_found for row in L.scan(docs(texts)).collect()}
    assert got == {(i, 0): 1 for i in range(3000)}
    # 11 of 13 shingles in a row, and each of the other two for itself at an end
    cut = [f"{' '.join(gpl[:5])} {prose(r, 'aa', 9)} {' '.join(gpl[1:-1])} {prose(r, 'aa', 9)} {' '.join(gpl[-5:])}" for _ in range(400)]
    found = L.scan(docs(cut)).where("template = 4").collect()
    assert len(found) == 400 and {row.n_found for row in found} == {len(gpl) - 4}


def test_license_plan_is_native(docs):
    plan = L.scan(docs(["a"]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


PAGES = [
    (None, ""), ("", ""), ("<html><body></body></html>", ""),
    ("<article><h1>A &amp; B</h1><p>x\n  y<br>z</p><div class='ad'>buy</div><p>&lt;ok&gt; &#233;&nbsp;e</p></article>",
     "A & B\n\nx y z\n\n<ok> é e"),
    ("<nav>a b</nav><main><p>one<p><b>two<p>three<script>var a='</p>';</script></main><footer>f</footer>", "one\n\ntwo\n\nthree"),
    ("<p>The words of this one are in the text and it is good.<p>Short.<p>As is the end of it, for this is on the list.",
     "The words of this one are in the text and it is good.\n\nShort.\n\nAs is the end of it, for this is on the list."),
    ("<article>" + "<p>t</p>" * 3000 + "</article><!-- c --><aside>s</aside><form>f <button>b</button></form>", "\n\n".join(["t"] * 3000)),
    ("<div id='comments'><p>I like that it is on the web and for the people.</p></div><article a='>'>x</article>", "x"),
    ("<div><a href=x>one two three</a> <a href=y>four five six seven</a></div><p hidden>This is of the hidden and it is on it.</p>", ""),
    ("<p>unclosed <b>and the rest of this is in the one that it is", "unclosed and the rest of this is in the one that it is"),
]


@pytest.mark.parametrize(("page", "text"), PAGES)
def test_main_text(page, text):
    assert main_text(page or "") == text


POLISH = "Wczoraj wieczorem mieszkańcy miasteczka zebrali się przed ratuszem, żeby wspólnie obejrzeć pokaz dawnych rzemiosł i posłuchać opowieści starszych sąsiadów przy ognisku"
ENGLISH = "It was the end of the day, and the people of the town were on their way to the river for the first time in years."
LINKS = "<ul><li><a href=a>Home</a></li><li><a href=b>All the news of the day that is in the paper</a></li></ul>"


@pytest.mark.parametrize("prose", [POLISH, ENGLISH, "会议昨天在北京举行，来自各地的代表讨论了未来几年的计划和预算，并就教育、交通与环境等问题交换了意见。" * 2])
@pytest.mark.parametrize("frame", ["<div>{}</div>", "<td>{}", "<article>{}</article>", "{}"])
def test_prose_without_help_of_tags(prose, frame):
    page = LINKS + frame.format(f"<h2>Title</h2><p>{prose}</p><p>Short one.</p>") + "<footer>(c) " + ENGLISH + "</footer>"
    assert main_text(page) == f"Title\n\n{prose}\n\nShort one."


def test_densities_judge_inside_an_article_too():
    page = f"<article><p>{ENGLISH}</p>{LINKS}<p>{ENGLISH}</p></article>"
    assert main_text(page) == f"{ENGLISH}\n\n{ENGLISH}"


def test_points_of_the_first_pass():
    few = " ".join(["keyword"] * 12)
    found = [Block(ENGLISH, "p", 0, False, False), Block(few, "p", 0, False, False), Block(few, "p", 0, False, True),
             Block("Short one", "p", 0, False, False), Block(ENGLISH, "p", 0, True, False), Block(ENGLISH, "p", 100, False, True)]
    assert first_pass(found, Rules()) == [True, False, None, None, False, False]
    assert first_pass(found[1:3], Rules()) == [None, True]  # no stop words at all: the language is not listed


def test_second_pass_equals_a_plain_search():
    r = random.Random(3)
    for _ in range(2000):
        first = [r.choice([True, False, None, None, None]) for _ in range(r.randint(0, 12))]
        heads = [r.random() < 0.3 for _ in first]
        for i, good in enumerate(second_pass(first, heads)):
            known = [j for j, x in enumerate(first) if x is not None]
            near = [j for j in known if abs(i - j) == min(abs(i - k) for k in known)]
            if not known:
                want = True
            elif len(near) == 1 or first[near[0]] == first[near[1]]:
                want = first[near[0]]
            else:
                want = first[max(near)] if heads[i] else False
            assert good == want


@pytest.mark.parametrize("piece", ["<b>", "<a '", '<a "', "<a>x", "<table><i></p>", "<p><i>", "<script>", "<!--", "</div>", "<", "<svg/>", "<a b='>'", "<a x>'"])
def test_long_odd_pages_take_little_time(piece):
    began = time.process_time()
    main_text(piece * (1_000_000 // len(piece)))
    assert time.process_time() - began < 6


def test_pages_as_frame(spark):
    rows = [(i, None if i == 2 else f"u{i}", p, "t") for i, (p, _) in enumerate(PAGES)] + [(None, None, None, None), (0, "u0", None, "t")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(frame).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id:
            assert (r.text, r.n_chars) == (PAGES[r.page_id][1], len(PAGES[r.page_id][1]))
    assert extract(frame.limit(0)).collect() == []
