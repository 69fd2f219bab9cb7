"""WARC revisits, conversation repair and spelling variants: against brute force and plain
loops, with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import base64
import hashlib
import heapq
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bikelake.llm import spelling, turn_repair, warc
from bikelake.llm.common import lookup_spread, open_folder, shared_uri, ship_package

CLASH = ("score", "list", "own", "kind", "digest", "copies", "signature", "start", "same", "first", "n", "root", "__x")


@pytest.fixture(autouse=True)
def _code(spark):
    ship_package(spark)


def clashing(df):
    for c in CLASH:
        if c not in df.columns:
            df = df.withColumn(c, F.lit("clash"))
    return df


# ---------------------------------------------------------------- shared lookup

def test_lookup_spread_joins_like_a_plain_join(spark):
    rows = spark.createDataFrame([(k, "hot" if k % 3 else f"k{k % 7}") for k in range(200)] + [(900, None), (901, "none")], "i long, k string")
    found = spark.createDataFrame([("hot", 1), *((f"k{j}", j) for j in range(5))], "k string, v long")
    got = {r.i: r.v for r in lookup_spread(rows, found, ["k"], ["i"], salts=4).collect()}
    assert got == {r.i: r.v for r in rows.join(found, "k", "left").collect()}


# ---------------------------------------------------------------- WARC

PAGES = "page_id long, url string, html string"


def want_warc(rows, least=0):
    first = {}
    for page, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        first.setdefault(html or "", page)
    out, used = [], set()
    for page, url, html in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or "")):
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        new = len(data) < least or (html or "") not in used
        used.add(html or "")
        out.append((page, len(data), digest, "response" if new else "revisit", None if new else first[html or ""]))
    return Counter(out)


def through(spark, pages, least=0, **kw):
    folder, index = warc.write_archives(spark, pages, **kw)
    out, deduplicated = warc.deduplicate(spark, folder, index, min_bytes=least, **kw)
    records = warc.read_records(spark, out, deduplicated)
    rows = warc.resolved_records(records).collect()
    return Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), out, deduplicated


WARC_ROWS = [(5, "http://a/1", "<p>same</p>"), (2, "http://a/2", "<p>same</p>"), (9, None, "<p>same</p>"),
             (1, "http://x/%20é\r\nInjected: 1", "own\r\n\r\nWARC/1.1\r\n"), (3, "u", None), (4, "u", ""), (7, "u", "é" * 70_000),
             (2, "http://a/2", "<p>same</p>"), (2, "http://a/0", "other"), (None, "n", "<p>same</p>"), (None, None, "lonely"),
             (8, "u", "other"), (10, "u", "\x00\x01 <|")] + [(100 + k, "hot", "copy") for k in range(300)]


@pytest.mark.parametrize("least", [0, 5, 1000])
def test_warc_round_trip(spark, least):
    pages = clashing(spark.createDataFrame(WARC_ROWS, PAGES).repartition(3))
    got, *_ = through(spark, pages, least)
    assert got == want_warc(WARC_ROWS, least)


def test_warc_rolls_archives_and_keeps_headers_on_one_line(spark):
    pages = spark.createDataFrame(WARC_ROWS, PAGES).coalesce(1)
    got, out, index = through(spark, pages, archive_bytes=2_000)
    assert got == want_warc(WARC_ROWS)
    assert index.select("archive").distinct().count() > 3
    urls = {r.page_id: r.url for r in warc.read_records(spark, out, index).collect()}
    assert urls[1] == WARC_ROWS[3][1] and urls[9] is None
    # any record is read on its own by its place in the index
    r = index.filter("page_id = 7").first()
    fs, root = open_folder(out)
    with fs.open_input_file(f"{root}/{r.archive}") as f:
        f.seek(r.offset)
        fields, payload = warc.parse(zlib.decompress(f.read(r.length), 31))
    assert payload.decode() == "é" * 70_000 and fields["page-id"] == "7"


def test_warc_finds_damage(spark):
    record = warc.render("response", 1, "u", b"payload", warc.payload_digest(b"payload"), 7)
    plain = zlib.decompress(record, 31)
    assert warc.parse(plain)[1] == b"payload"
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(plain.replace(b"payload\r\n", b"pAyload\r\n"))
    import io
    with pytest.raises(ValueError, match="ends within"):
        list(warc._members(io.BytesIO(record + record[:-9])))
    assert len(list(warc._members(io.BytesIO(record * 3), piece=7))) == 3


def test_warc_empty_table_and_folder_without_scheme(spark, tmp_path):
    got, *_ = through(spark, spark.createDataFrame([], PAGES))
    assert not got
    assert shared_uri(spark, str(tmp_path)).startswith("file:/")
    folder, index = warc.write_archives(spark, spark.createDataFrame(WARC_ROWS[:3], PAGES).coalesce(1), str(tmp_path))
    assert [p.name for p in tmp_path.glob("*.warc.gz")] == [index.first().archive]


# ---------------------------------------------------------------- conversations

TURNS = "conv_id long, turn long, role string, text string"


def brute_repair(rows):
    """Cheapest audit by Dijkstra over (rows used, grammar state); rows: (turn, role, text) in order."""
    seen, must, cut = set(), [], []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        must.append(not body or (role, text) in seen)
        cut.append(bool(body) and not must[-1] and body[-1] not in ".!?")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    queue = [(0, "", 0, "", ())]
    done = set()
    while queue:
        cost, audit, k, state, out = heapq.heappop(queue)
        if k == len(rows) and state in ("", "a"):
            return cost, audit, "\n".join(out)
        if (k, state) in done:
            continue
        done.add((k, state))
        for role in ("user", "assistant"):
            if (state, role[0]) in after:
                heapq.heappush(queue, (cost + 5, audit + "I", k, after[state, role[0]], (*out, f"{role}:")))
        if k < len(rows):
            _, role, text = rows[k]
            heapq.heappush(queue, (cost + 2, audit + "D", k + 1, state, out))
            if not must[k]:
                if (state, role[:1]) in after:
                    heapq.heappush(queue, (cost + 5 * cut[k], audit + "K", k + 1, after[state, role[:1]], (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    if (state, new[0]) in after:
                        heapq.heappush(queue, (cost + 1 + 5 * cut[k], audit + "R", k + 1, after[state, new[0]], (*out, f"{new}:{text}")))


def brute_conversations(rows):
    """Rows (conv, turn, role, text) as given, by the contract's words."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, rs in convs.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        turns = [t for t, *_ in rs if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        blank = duplicate = truncated = illegal = 0
        seen = set()
        for k, (_, r, x) in enumerate(rs):
            body = x.strip(" \t\n\x0b\x0c\r")
            blank += not body
            duplicate += bool(body) and (r, x) in seen
            truncated += bool(body) and (r, x) not in seen and body[-1] not in ".!?"
            seen.add((r, x))
            illegal += k > 0 and rs[k - 1][1][:1] + r[:1] not in ("su", "ua", "au")
        cost, audit, text = brute_repair(rs)
        out[c] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())
    return out


def random_turns(rng, n=120):
    rows = []
    for c in [None, *range(n)]:
        for k in range(rng.randrange(0, 9)):
            rows.append((c, rng.choice([k, k, k, k + 3, None]), rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "ursula"]),
                         rng.choice(["Hello.", "Hi!", "cut", " \n", "", None, "cut é ", "Hello.", f"text {rng.random()}."])))
    return rows


def test_repair_against_brute_force(spark):
    rows = random_turns(random.Random(5))
    rows += rows[:40]                                            # repeated rows
    df = clashing(spark.createDataFrame(rows, TURNS).repartition(4))
    got = {r.conv_id: tuple(r)[1:] for r in turn_repair.repair(spark, turn_repair.as_rows(df)).collect()}
    assert got == brute_conversations(rows)


def test_repair_of_damaged_rows(spark):
    rng = random.Random(9)
    rows = [(c, t, ("user", "assistant")[t % 2], f"Row {c} {t}! Yes{rng.choice('.!? ')}") for c in range(150) for t in range(rng.randrange(1, 9))]
    rows += [(c, 0, "user", "Alone.") for c in range(3000, 3100)]
    rows += [(1000, 3, None, None), (None, None, "user", "x. "), (2000, None, "user", "Well.")]
    hurt = []
    for c, t, r, x in rows:
        h = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        x = "" if h == 1 else re.sub("[.!?]", "", x) if h == 2 else x
        hurt += [(c, t, "user" if h == 4 else r, x)] * (0 if h == 0 else 2 if h == 3 else 1)
    want = brute_conversations(hurt)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    got = {r.conv_id: tuple(r)[1:] for r in
           turn_repair.repair(spark, turn_repair.damaged(spark.createDataFrame(rows, TURNS))).collect()}
    assert got == {c: want.get(c, empty) for c in {r[0] for r in rows}}
    assert any(v == empty for v in got.values())                 # a conversation that lost all its rows


def test_suffix_automaton_shares_suffixes_and_equals_brute_force():
    rng = random.Random(3)
    symbols = "suaxSUAXd"
    texts = {"".join(rng.choice(symbols) for _ in range(rng.randrange(8))) for _ in range(3000)} | {""}
    role = {"s": "system", "u": "user", "a": "assistant", "x": "tool"}
    automaton = turn_repair.SuffixAutomaton()
    for text in sorted(texts, key=lambda t: t[::-1]):
        rows = [(0, role.get(c.lower(), "user"), "" if c == "d" else f"{k}" + ("" if c.isupper() else "."))
                for k, c in enumerate(text)]
        assert automaton.repair(text) == brute_repair(rows)[:2], text
    assert automaton.made == len({t[k:] for t in texts for k in range(len(t))})   # every suffix once


def test_long_conversation_in_little_memory(spark):
    n = 30_000
    df = spark.range(n).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
                               F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
                               F.concat(F.lit("t "), F.col("id").cast("string"), F.lit(".")).alias("text"))
    (row,) = turn_repair.repair(spark, turn_repair.as_rows(df)).collect()
    assert (row.cost, row.audit) == (0, "K" * n)
    assert turn_repair.repair(spark, turn_repair.as_rows(spark.createDataFrame([], TURNS))).count() == 0


# ---------------------------------------------------------------- spelling

DOCS = "doc_id long, text string, source string"


def edit_one(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def brute_words(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= 2}
    near = {w: [v for v in n if edit_one(w, v)] for w in n}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def word_rows(rng):
    chunks = ["an", "ther", "tion", "in", "er", "é", "ñand", "o", "st", "ß", "÷a"]
    base = ["".join(rng.choice(chunks) for _ in range(rng.randrange(2, 6))) for _ in range(60)]

    def variant(w):
        k = rng.randrange(len(w) + 1)
        return rng.choice([w[:k] + rng.choice("aené") + w[k:], w[:k] + w[k + 1:], w[:k] + rng.choice("aen") + w[k + 1:]])
    words = base + [variant(rng.choice(base)) for _ in range(300)]
    words += [variant(w) for w in words[60:200]]
    rows = [(rng.choice([None, *range(400)]), rng.choice([" ", "\n", "7", "-", "Ω"]).join(
        rng.choice([str, str.upper, str.title])(rng.choice(words[:rng.choice([3, 60, len(words)])])) for _ in range(40))) for _ in range(250)]
    return rows + rows[:30] + [(1, None), (2, ""), (3, "x" * 20_000 + " " + "x" * 20_000 + " " + "x" * 19_999), (4, "x" * 19_999),
                               (6, "chainedx " * 600 + "chained " * 30 + "chaned " * 3), (7, "chained " * 2 + "chainet " * 2),
               (5, "WORDWORD " * 900 + "wordword wordwor wordwor wordwork wordwork " * 3)]


def test_spelling_against_brute_force(spark):
    rows = word_rows(random.Random(11))
    df = clashing(spark.createDataFrame([(*r, "s") for r in rows], DOCS).repartition(4))
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.spelling_variants(spark, df).collect()}
    want = brute_words(rows)
    assert got == want
    assert any(root != form for form, root, *_ in want.values() if form)     # a way of more than one form
    assert max(len(w) for w in got) >= 19_999


def test_near_words_share_an_owned_list():
    rng = random.Random(2)
    for _ in range(6000):
        letters = rng.choice(["ab", "abc", "abcdef"])
        index = spelling.GramIndex("".join(rng.choice(letters) for _ in range(3)) for _ in range(rng.randrange(30)))
        a = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 14)))
        k = rng.randrange(len(a) + 1)
        b = rng.choice([a[:k] + rng.choice(letters) + a[k:], a[:k] + a[k + 1:], a[:k] + rng.choice(letters) + a[k + 1:]])
        if len(b) >= 7 and edit_one(a, b):
            x, y = spelling.list_keys(index, a), spelling.list_keys(index, b)
            assert any(p == q and (i or j) for (i, p), (j, q) in itertools.product(x, y)), (a, b, index.grams)


def test_gram_dictionary_is_bounded_by_share(spark):
    words = spark.createDataFrame([(f"{k:08b}".replace("0", "a").replace("1", "b"), 2) for k in range(256)], "word string, n long")
    some = spelling.gram_dictionary(words, share=10)
    assert len(some) <= 10 and all(len(g) == 3 for g in some) and len(spelling.gram_dictionary(words, share=3)) <= 3
    assert spelling.gram_dictionary(words.limit(0)) == []


def test_spelling_empty_table_and_short_words(spark):
    assert spelling.spelling_variants(spark, spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError, match="code points"):
        spelling.near_pairs(spark, spark.createDataFrame([("abc", 2)], "word string, n long"), min_length=3)
