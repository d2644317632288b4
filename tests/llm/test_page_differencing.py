"""Differencing of pages with marked articles; alignment of lines that repeat often."""

import random
import time

import pytest

from verdance.llm import pagetext


def texts(spark, rows):
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in pagetext.main_text(table).collect()}


def article(*body, around=""):
    return f"<nav><p>Menu</p></nav>{around}<article>" + "".join(f"<p>{x}</p>" for x in body) + "</article>"


@pytest.mark.parametrize("tag", ["article", "main"])
def test_frames_in_articles_are_deleted(spark, tag):
    """Lines that the host's articles share go; a sentence that two of them share stays."""
    own = lambda i: f"Story number {i} tells of something else, at some length"
    rows = [(i, f"http://h/a/{i:02}", article("Follow our site", own(i), *(["A saying"] if i in (3, 4) else []), "Tell a friend")) for i in range(9)]
    rows = [(i, u, h.replace("article>", f"{tag}>")) for i, u, h in rows]
    got = texts(spark, rows)
    assert got == {i: f"{own(i)} A saying" if i in (3, 4) else own(i) for i in range(9)}


def test_what_does_not_prove_a_frame_in_articles(spark):
    """Few pages, and copies and near-copies of one article, which are one run."""
    long = [f"{i}th sentence of a story that is told on more than one page" for i in range(12)]
    few = [(i, f"http://few/{i}", article("Shared line", f"Story {i} that differs from all others")) for i in range(4)]
    near = [(10 + i, f"http://near/a/{i:02}", article("Shared line", *long, f"changed {i}")) for i in range(20)]
    near += [(40 + i, f"http://near/b/{i}", article("Shared line", f"Another {i} story that differs from all others")) for i in range(3)]
    copies = [(50 + i, f"http://copies/{i}", article("Shared line", *long, around=f"<p>Unmarked {i}</p>")) for i in range(8)]
    got = texts(spark, few + near + copies)
    want = {i: f"Shared line Story {i} that differs from all others" for i in range(4)}
    want |= {10 + i: " ".join(["Shared line", *long, f"changed {i}"]) for i in range(20)}
    want |= {40 + i: f"Shared line Another {i} story that differs from all others" for i in range(3)}
    assert got == want | {50 + i: " ".join(["Shared line", *long]) for i in range(8)}


def test_pages_with_and_without_articles_are_neighbours(spark):
    """A page without an article finds its frame on one that has the same lines in its article."""
    rows = [(1, "http://h/1", article("Our site", "first story with words of its own", "Bye"))]
    rows += [(2, "http://h/2", "<p>Our site</p><p>second story, quite another one</p><p>Bye</p>")]
    assert texts(spark, rows) == {1: "Our site first story with words of its own Bye", 2: "second story, quite another one"}


def test_alignment_of_lines_that_repeat(monkeypatch):
    rnd = random.Random(3)
    for held in (1 << 27, 16):
        monkeypatch.setattr(pagetext, "ROWS_HELD", held)
        for _ in range(200):
            a, b = ([rnd.randint(0, 3) for _ in range(rnd.randint(0, 14))] for _ in range(2))
            table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
            for i, x in enumerate(a):
                for j, y in enumerate(b):
                    table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
            found = sorted(pagetext._aligned_rows(a, b, 0))
            assert len(found) == len(set(found)) == table[-1][-1]
            at = 0
            for i in found:
                at = b.index(a[i], at) + 1
    monkeypatch.undo()
    began = time.process_time()
    assert len(pagetext.common_subsequence([1, *[2, 3] * 25_000, 4], [5, *[2] * 25_000, *[3] * 25_000, 6])) == 25_001
    assert time.process_time() - began < 30
