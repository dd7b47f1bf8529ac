import numpy as np
import pytest

from tickflow.llm.extract import extract_main_text, train
from tickflow.llm.html_blocks import blocks
from tickflow.llm.page_samples import labelled_pages


@pytest.fixture(scope="module")
def chain():
    return train(labelled_pages())


def test_blocks_of_broken_markup():
    page = (
        "<!DOCTYPE html><title>T &amp am</title><script>if (a < b) '</p>'</script><style>p{}</style>"
        "<!-- <p>no</p> --><div class='x'><p>One<b>two <i>three</b><br>four&nbsp;&lt;x&gt;<p>Five 1 < 2 <ul><li>a<li>b</ul>"
        "<a title='>' href=x>link</a> &copy<p class=\"cut"
    )
    found = blocks(page)
    assert [b.text for b in found] == ["T & am", "Onetwo three four <x>", "Five 1 < 2", "a", "b", "link ©"]
    assert found[1].tags == ("div", "p") and "x" in found[1].names
    assert found[3].tags == ("div", "ul", "li") and found[5].linked >= 0.4
    assert blocks("") == [] and blocks("<p> \n</p>") == [] and blocks("plain") != []
    assert len(blocks("<div>" * 3000 + "deep")) == 1


def test_held_out_pages(chain):
    truth, told = [], []
    for page in labelled_pages(150, seed=77):
        found = blocks(page)
        truth += [block.marked for block in found]
        told += chain.decode(found)
    assert np.mean(np.array(truth) == np.array(told)) > 0.985


def test_viterbi_equals_all_paths(chain):
    from itertools import product

    from tickflow.llm.extract import features

    for page in labelled_pages(25, seed=5_000):
        found = blocks(page)[:9]
        scores = [chain.weights[numbers].sum() for numbers in features(found)]

        def worth(path, scores=scores):
            return sum(s for s, on in zip(scores, path) if on) + sum(chain.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(product((0, 1), repeat=len(found)), key=worth)
        assert worth(chain.decode(found)) == pytest.approx(worth(best))


def test_given_pages_against_their_articles(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r.page_id: r.text for r in extract_main_text(pages).collect()}
    for row in pages.collect():
        inside = row.html.split("<article>")[1].split("</article>")[0].replace("<br>", " ")
        lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:h1|p)>", inside)]
        assert got[row.page_id] == "\n".join(x for x in lines if x)


def test_nulls_empty_repeats_and_other_columns(spark):
    page = "<nav><a href=x>Menu</a></nav><article><p>It is the text of the page.</p></article>" * 1
    rows = [(1, "u", page, "t"), (1, "u", page, "t"), (None, None, page, None), (2, "v", None, "t"), (3, "w", "", "t"), (4, "x", "<p>" + "word " * 30_000, "t")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract_main_text(frame)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in got.collect()}
    assert found[1, "u"] == found[None, None] == ("It is the text of the page.", 27)
    assert found[2, "v"] == found[3, "w"] == ("", 0)
    assert found[4, "x"][1] == 149_999 and got.count() == 6
    assert extract_main_text(frame.limit(0)).count() == 0


def test_forms_and_templates_are_no_text(chain):
    page = "<article><p>It is the text of the page.</p><textarea>Say it <b>here</b></textarea><template><p>Not yet shown.</p></template><p>More of the text is here.</p></article>"
    assert chain.main_text(page) == "It is the text of the page.\nMore of the text is here."


def test_scores_are_those_of_all_features(chain):
    from tickflow.llm.extract import features

    for page in labelled_pages(10, seed=9_000):
        found = blocks(page)
        assert chain.scores(found) == pytest.approx([chain.weights[numbers].sum() for numbers in features(found)])


@pytest.mark.parametrize("unit", ["<div>x", "<div class=a{}>x", "<p><button><div>x", "</p><i></div x>", "<td>x</ul>", "<li>x"])
def test_time_and_memory_grow_with_the_page(chain, unit):
    import time
    import tracemalloc

    def word(number):
        return "".join(chr(97 + number // 26**k % 26) for k in range(4))

    def page(size):
        return "".join(unit.replace("{}", word(number)) for number in range(size // len(unit)))

    took = []
    for size in (1 << 18, 1 << 20):
        text = page(size)
        start = time.process_time()
        chain.main_text(text)
        took.append(time.process_time() - start)
    assert took[1] < 9 * took[0] + 1
    tracemalloc.start()
    chain.main_text(page(1 << 16))
    assert tracemalloc.get_traced_memory()[1] < 40_000_000
    tracemalloc.stop()
