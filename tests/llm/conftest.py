"""Small documents with every odd case: null, empty, blank and long texts, ties, copies, near copies."""

from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, token string"


def odd_texts() -> list[str | None]:
    rng = random.Random(5)
    words = ["the", "of", "and", "Le", "der", "niño", "straße", "été", "idiot", "x1", "\U0001f600"]
    words += ["".join(rng.choices("abcdehilnorstu", k=rng.randint(3, 9))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    first, passage = prose(120), prose(90)
    near = first.split(" ")
    near[60] = "changed"
    out: list[str | None] = [None, "", "   \t\n", "...", "a", "one two three", "One  two\nthree", "12345 678"]
    out += [first, first, first.upper(), " ".join(near), first + " tail"]
    out += [prose(80) + " " + passage + " " + prose(70), prose(60) + "\n" + passage + "\n" + prose(30), passage]
    out += ["again and again " * 60, "line\n" * 40 + prose(30), prose(3000)]
    out += ["call +1 (212) 555-0199 or mail a.b@ex-ample.org, 10.0.0.256 1.2.3.4 4539578763621486."]
    out += ["x@y +123 1.2.3.4.5 4539 5787 6362 1486 @@ a@b.c@d.e ++1 234 567 8901 99999999999999999999"]
    out += [prose(rng.randint(5, 200)) for _ in range(40)]
    return out


@pytest.fixture(scope="session")
def rows() -> list[tuple]:
    langs = ["en", "fr", None, "de"]
    return [
        (i * 7 - 3, t, langs[i % 4], "src", len(t or ""), 0.5, "clash") for i, t in enumerate(odd_texts())
    ]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark, rows):
    marks = [(r[0], 1, int("idiot" in (r[1] or ""))) for r in rows] + [(None, 1, 1), (rows[0][0], 0, None)]
    return spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def page(title: str, *body: str) -> str:
    """A page as those of the table are: menu, advert, article and footer, some end tags missing."""
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style>"
        '<script>var t="</p>";track(0);</script></head><body><nav><ul><li><a href="/x">menu</a></li></ul></nav>'
        f'<!-- ad --><div class="ad">Buy this now.</div><article><h1>{title}</h1>{"".join(body)}</article>'
        "<footer>&copy; here</footer>"
    )


@pytest.fixture(scope="session")
def pages(spark):
    prose = "Words of an article that go on &amp; on, with a <b>bold</b> one"
    html = [None, "", "<p></p>", page("One", f"<p><b>{prose}.<br><p>{prose}\n  twice.</p>"), page("R&amp"), page("")]
    html += [page("Long", *[f"<p>{prose} {i}.</p>" for i in range(40_000)]), html[3]]
    rows = [(i * 3, f"u{i}", t, "clash") for i, t in enumerate(html)] + [(None, None, html[3], None), (0, "u0", None, "")]
    return spark.createDataFrame(rows, "page_id long, url string, html string, text string")


@pytest.fixture(scope="session")
def conversations(spark):
    """Rows of every fault, conversations of one row to thousands, null ids, turns, roles and texts."""
    rng = random.Random(11)
    roles = ["system", "user", "assistant", "tool", None, "User", "", "user", "assistant"]
    said = ["Yes.", "no", "Really?", "", None, " \t", "Go on!  \n", "x" * 50_000 + ".", "Ça va… bien", "done."]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8, 12])):
            own = rng.choice([turn, turn, turn, turn + 2, None, 0])
            rows.append((conv, own, rng.choice(roles), rng.choice(said) if rng.random() < 0.4 else f"said {rng.random()}."))
    for turn in range(9000):
        rows.append((1000, turn, ["user", "assistant"][turn % 2] if rng.random() < 0.9 else "system", f"turn {turn % 4000}."))
    rows = [(c, t, r, x, 7, "clash") for c, t, r, x in rows]
    return spark.createDataFrame(rows + rows[:20], "conv_id long, turn long, role string, text string, copies int, kind string")


@pytest.fixture(scope="session")
def sf_dir(spark, docs, labels, pages, conversations, tmp_path_factory):
    """The tables as a query reads them."""
    folder = tmp_path_factory.mktemp("tables")
    for name, rows in (("documents", docs), ("labels", labels), ("pages", pages), ("conversations", conversations)):
        rows.write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


@pytest.fixture(scope="session")
def empty_dir(spark, empty, labels, pages, conversations, tmp_path_factory):
    folder = tmp_path_factory.mktemp("empty")
    empty.write.parquet(f"{folder}/documents.parquet")
    for name, rows in (("labels", labels), ("pages", pages), ("conversations", conversations)):
        rows.limit(0).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
