"""Nothing is dropped by size: wide components, large bins, many languages, articles in forms."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bikelake.llm import bitslice, html_text, langid, packing
from bikelake.llm.common import ship_package


@pytest.fixture(autouse=True)
def _code(spark):
    ship_package(spark)


def test_wide_components_are_ranked_exactly(spark):
    rng = random.Random(3)
    vectors = [[1.0, 2.0], [1e14, 1.0], [3e300, -1.0], [-3e300, 5.0], [2.0 ** 54, 0.0], [2.0 ** 54, 1.0], [0.0, 7.0], [1.7e308, 1.0], [0.0, -1e17]]
    vectors += [[rng.uniform(-1, 1) * 10 ** rng.randrange(18), rng.uniform(-9, 9)] for _ in range(60)]
    vectors += [None, [], [float("inf"), 1.0], [float("nan"), 1.0], [None, 1.0]]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").withColumn("beyond", F.lit("x"))

    def integers(v):
        return [int(x) * 256 if abs(x) >= 2 ** 53 else math.floor(x * 256) for x in v]

    real = {i: integers(v) for i, v in enumerate(vectors) if v and all(x is not None and math.isfinite(x) for x in v)}
    most = (1 << 63) - 1
    want = {}
    for q in (0, 2, 3, 6, 8, 20, 40):
        found = sorted(((-sum(x * y for x, y in zip(real[q], v)), i) for i, v in real.items() if i != q))[:5]
        want.update({(q, k + 1): (i, max(-most, min(most, -s))) for k, (s, i) in enumerate(found)})
    asked = df.filter(F.col("vec_id").isin(0, 2, 3, 6, 8, 20, 40))
    got = {(r.query_id, r["rank"]): (r.id, r.score) for r in bitslice.top_k(spark, df, asked, 5, row_block=7, query_block=3).collect()}
    assert got == want


def test_pairs_are_exchanged_in_bins_of_many_pieces():
    # two bins of many small pieces: the gap of one closes only by two of its pieces for one of the other's
    rng = random.Random(7)
    for _ in range(5):
        lengths = [rng.randrange(3, 30) for _ in range(600)]
        bins = packing.pack_lengths(lengths, 1024)
        assert sorted(i for b in bins for i in b) == list(range(600)) and all(sum(lengths[i] for i in b) <= 1024 for b in bins)
        assert len(bins) == -(-sum(lengths) // 1024)
    big = [1] * 98 + [20, 22]                      # 100 pieces, 140 tokens: 1 + 20 or 20 + 22 for 43 fills 141
    bins = packing.improve([list(range(100)), [100, 101]], big + [43, 60], 141)
    assert max(sum((big + [43, 60])[i] for i in b) for b in bins) == 141


def test_every_language_is_learned(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    rng = random.Random(1)
    rows = []
    for k in range(420):
        words = ["".join(rng.choice(letters) for _ in range(9)) for _ in range(4)]
        rows += [(len(rows) + j, " ".join(words), f"l{k:03d}") for j in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(df)
    assert len({p[0] for p in model.predict([r[1] for r in rows[::2]])}) == 420
    assert model.predict([rows[-1][1]])[0][0] == "l419"


STORY = "Plain words that tell a long story about rivers and the towns beside them."


@pytest.mark.parametrize("page, want", [
    (f"<body><form><article><h1>T</h1><p>{STORY}</p></article><nav><a>menu</a></nav></form></body>", f"T\n{STORY}"),
    (f"<body><header>Site</header><article><header><h1>Title</h1></header><p>{STORY}</p></article><footer>foot</footer></body>", f"Title\n{STORY}"),
    (f"<body><article><p>{STORY}</p></article><form>name <input> send</form><header>x y z</header><dialog>ok</dialog></body>", STORY),
    (f"<body><article><header class='ad'>buy</header><p>{STORY}</p></article></body>", STORY),
])
def test_containers_around_and_in_articles(page, want):
    assert html_text.extract(page, {}) == want


def test_text_after_a_paragraph_of_links_is_kept():
    links = " ".join(f'<a href="/{k}">link {k}</a>' for k in range(30))
    got = html_text.extract(f"<body><nav>{links}</nav><article><p>{STORY}</p><p>{links}</p><p>The end is near.</p></article></body>", {})
    assert got.split("\n")[0] == STORY and got.split("\n")[-1] == "The end is near." and got.count("link") == 30


def brute_region(scores):
    best, span = 0.0, (0, 0)
    for a in range(len(scores)):
        run = 0.0
        for b in range(a, len(scores)):
            run += scores[b]
            if run > best + 1e-9:
                best, span = run, (a, b + 1)
    return span


def test_scan_equals_brute_force_over_all_regions():
    rng = random.Random(5)
    for _ in range(300):
        parts = [rng.choice(["<div>", "</div>", "<table><tr><td>cell</td></tr></table>", f"<p>{'w ' * rng.randrange(1, 9)}</p>", "<hr>"])
                 for _ in range(rng.randrange(1, 14))]
        page, weights = "".join(parts), {"p": rng.choice([0.0, 0.5, 1.5]), "div": 1.0, "table": 2.0, "td": 2.0, "tr": 0.5, "hr": 3.0}
        known = {**html_text.PRIOR, **weights}
        steps = []
        for kind, key, stack, _, text in html_text.events(page):
            if kind == "text":
                steps.append((len(text.split()) * (1.0 - max((known.get(s[1], 0.0) for s in stack), default=0.0)), text))
            else:
                steps.append((-html_text.TAG_COST - known.get(key, 0.0), None))
        a, b = brute_region([s for s, _ in steps])
        want = [" ".join(t.split()) for _, t in steps[a:b] if t]
        assert html_text.extract(page, weights).split() == " ".join(want).split(), page


def test_deep_pages_take_memory_in_proportion():
    import tracemalloc
    sizes = []
    for depth in (1_000, 4_000):
        page = "<div>" * depth + STORY + "</div>" * depth
        tracemalloc.start()
        assert html_text.extract(page, {"div": 0.0}) == STORY
        sizes.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert sizes[1] < 6 * sizes[0]
