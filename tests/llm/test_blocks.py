import random
import time

import numpy as np
import pytest

from corpusforge.llm import blocks


def test_broken_markup_is_read_in_one_pass():
    t = time.perf_counter()
    n = 350_000
    assert blocks.leaves("<a " * n)[0].text.startswith("<a <a")
    assert blocks.leaves("<a " * n + ">x")[0].text == "x"
    for part in ("<a<", "<!", "<a \"", "<a '\"", "<", "</div", "<p a=\"<", "&#"):
        blocks.leaves(part * (1_000_000 // len(part)))
        blocks.leaves(part * (500_000 // len(part)) + ">" + part * (500_000 // len(part)))
    deep = blocks.leaves("<div>" * 100_000 + "text" + "</section>" * 100_000 + "<li>a<li>b")
    assert [x.text for x in deep] == ["text", "a", "b"]
    assert len(blocks.leaves("<div class=x>y" * 100_000)) == 100_000
    assert time.perf_counter() - t < 30


def test_scanner_on_ordinary_markup():
    page = ("<!DOCTYPE html><html><head><title>T</title><script>if (a<b) x='</p>';</script></head><body><!-- <p>no</p> -->"
            "<p title='a > b' id=one>One <b>two</b>&amp;<br>three<p>Four <a href=\"x>y\">link</a></p>5 < 6 <ul><li>i<li>j</ul></body>")
    got = [(x.text, x.path.names[0], x.linked) for x in blocks.leaves(page)]
    assert got == [("T", "title", 0), ("One two& three", "p", 0), ("Four link", "p", 4), ("5 < 6", "body", 0), ("i", "li", 0), ("j", "li", 0)]
    assert [x.text for x in blocks.leaves("a <b \"unclosed> c <p>d</p>")] == ["a c", "d"]


def page(r, box, n=None, extra=True):
    words = [f"w{r.randrange(300)}" for _ in range(400)]
    say = lambda a, b: " ".join(r.choices(words, k=r.randint(a, b)))
    tag = box.split(" ")[0]
    body = [say(12, 40) + "." for _ in range(n or r.randint(4, 9))]
    nav = "<nav><ul>" + "".join(f"<li><a href='#'>{say(1, 2)}</a></li>" for _ in range(5)) + "</ul></nav>" if extra else ""
    foot = f"<div class='footer'>© {say(2, 5)}</div>" if extra else ""
    return f"<html><body>{nav}<{box}>" + "".join(f"<p>{b}</p>" for b in body) + f"</{tag}>{foot}</body></html>", "\n\n".join(body)


@pytest.mark.parametrize("box", ["div class=content", "div", "section class='post'", "article"])
def test_tables_without_article_elements_keep_their_text(spark, box):
    r = random.Random(3)
    rows = [(i, *page(r, box)) for i in range(60)]
    df = spark.createDataFrame([(i, "u", h) for i, h, _ in rows], "page_id long, url string, html string")
    got = {x.page_id: x.text for x in blocks.extract(df).collect()}
    assert sum(got[i] == t for i, _, t in rows) >= 57


def test_long_pages_train_and_are_read_in_parts(spark):
    r = random.Random(4)
    rows = [(i, *page(r, "article", n=400)) for i in range(6)] + [(9, *page(r, "article", n=10_000))]
    model = blocks.train([h for _, h, _ in rows[:6]])
    assert model is not None
    feat = blocks.Featurizer()
    seq = blocks.leaves(rows[1][1])
    whole, parts = (blocks.label_pages(model, [seq], feat, longest=p)[0] for p in (20_000, 50))
    assert (whole == parts).all()
    x, mask, _ = blocks.padded([feat(seq)])
    assert np.allclose(model.scores(x, mask)[:, 0], model.long_scores(seq, feat, 37), atol=1e-4)
    df = spark.createDataFrame([(i, "u", h) for i, h, _ in rows], "page_id long, url string, html string")
    got = {x.page_id: x.text for x in blocks.extract(df).collect()}
    kept = [sum(b in set(got[i].split("\n\n")) for b in t.split("\n\n")) / len(t.split("\n\n")) for i, _, t in rows]
    assert min(kept) > 0.95


def test_no_labels_means_the_rule_not_a_random_model(spark):
    df = spark.createDataFrame([(1, "u", "<nav>menu</nav>"), (2, "u", None), (3, "u", "<b>"), (None, None, "")],
                               "page_id long, url string, html string")
    assert blocks.fit_labeller(df) is None
    got = blocks.extract(df).collect()
    assert len(got) == 4 and all(x.text == "" and x.n_chars == 0 for x in got)
