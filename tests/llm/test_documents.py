"""Near-duplicates, decontamination and personal data against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from starwright.llm import decontam, pii, registry, simhash
from starwright.llm.components import smallest_reachable
from tests.llm.conftest import framed

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, shingle):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(part, 42) for part in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, max_bits):
    """Smallest id reachable per row, by comparing all pairs of distinct fingerprints."""
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def top(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= max_bits:
                root[max(top(a), top(b))] = min(top(a), top(b))
    smallest = {}
    for i, p in prints:
        if i is not None:
            smallest[top(p)] = min(i, smallest.get(top(p), i))
    return [(i, f"{p:016x}", smallest.get(top(p))) for i, p in prints]


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


def test_fingerprints_and_groups_of_odd_texts(odd, odd_rows):
    got = in_order(simhash.near_duplicates(odd, 3, 3).collect())
    prints = [(i, plain_fingerprint(text, 3)) for i, text in odd_rows]
    assert got == in_order(plain_groups(prints, 3))


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
def test_links_at_every_distance(spark, max_bits, monkeypatch):
    rng = random.Random(max_bits)
    prints = []
    for _ in range(30):
        seed = rng.getrandbits(64)
        for flips in (0, 1, 2, 3, 3, 3, 4, 5, 6):
            near = seed
            for bit in rng.sample(range(64), flips):
                near ^= 1 << bit
            prints.append((len(prints) * 7 % 271, near))
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints]
    frame = spark.createDataFrame(signed, "doc_id long, fingerprint long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: frame)
    got = in_order(simhash.near_duplicates(frame, 3, max_bits).collect())
    assert got == in_order(plain_groups(prints, max_bits))


def test_groups_of_an_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0


def test_a_long_chain_is_one_component(spark):
    links = spark.range(300).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    found = smallest_reachable(links.repartition(5), "test-chain").collect()
    assert sorted(row.node for row in found) == list(range(301))
    assert {row.component for row in found} == {0}


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_matches(docs, items, width):
    windows = {}
    for name, text in items:
        words = plain_words(text)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            key = tuple(words[i : i + width])
            windows.setdefault(key, set()).add("" if name is None else str(name))
    for i, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for size in {len(key) for key in windows}:
            for start in range(len(words) - size + 1):
                names = windows.get(tuple(words[start : start + size]))
                if names:
                    hit |= set(range(start, start + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield i, len(words), len(hit), len(found), digest, bool(hit)


RESULT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture(scope="module")
def passages(odd_rows):
    rng = random.Random(3)
    vocabulary = "alpha beta gamma delta the of été naïve 42 x".split()
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(1, 14)))) for i in range(25)]
    items += [(25, None), (26, "!?"), (None, "the of the"), (3, "another text of item three"),
              (3, items[3][1]), (27, "word " * 12), (28, "lazy dog")]
    docs = list(odd_rows)
    for i in range(200):
        words = rng.choices(vocabulary, k=rng.randint(0, 40))
        words[5:5] = (rng.choice(items)[1] or "").upper().split()
        docs.append((1000 + i, ", ".join(words)))
    return docs, items


def test_the_index_is_written_once(spark, passages, monkeypatch):
    """However many slices a benchmark has; and a block looks only at windows it may have."""
    docs, items = passages
    built, looked = [], []
    build, search = decontam.build_index, decontam.search
    monkeypatch.setattr(
        decontam, "build_index", lambda *given: built.append(1) or build(*given)
    )
    monkeypatch.setattr(decontam, "search", lambda *given: looked.append(1) or search(*given))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.decontaminate(framed(spark, docs), benchmark, width=4, slice_bytes=300)
    assert found.count() == len(docs)
    assert len(built) == 1 and len(looked) > 2


@pytest.mark.parametrize("slice_bytes", [1 << 20, 300])
def test_phrases_equal_brute_force(spark, passages, slice_bytes):
    docs, items = passages
    benchmark = framed(spark, items, "item_id long, text string")
    found = decontam.decontaminate(
        framed(spark, docs), benchmark, width=4, slice_bytes=slice_bytes
    )
    assert in_order(found.select(*RESULT).collect()) == in_order(plain_matches(docs, items, 4))


def test_proximity_finds_what_a_phrase_misses(spark):
    docs = framed(spark, [
        (1, "x zebra yak lion x"), (2, "zebra x yak lion"), (3, "zebra x x x x x x yak lion"),
    ])
    items = framed(spark, [(7, "zebra yak lion")], "item_id long, text string")
    found = {
        row.doc_id: (row.items, row.near_items)
        for row in decontam.decontaminate(docs, items, slack=2).collect()
    }
    assert found == {1: (["7"], ["7"]), 2: ([], ["7"]), 3: ([], [])}


def test_a_long_item_is_cut_into_slices(spark):
    rng = random.Random(8)
    words = [f"w{i:03}" for i in range(200)]
    parts = list(decontam.slices_of(iter([(1, " ".join(words)), (2, "a b")]), 4, 300))
    assert len(parts) > 5
    assert all(sum(4 * len(key) for _, key in p.windows) <= 300 for p in parts)
    assert sum(len(p.windows) for p in parts) == 198
    docs = [(i, " ".join(words[k : k + 9])) for i, k in enumerate(rng.sample(range(200), 40))]
    items = [(1, " ".join(words)), (2, "w007 w008")]
    found = decontam.decontaminate(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"), width=4, slice_bytes=300,
    )
    assert in_order(found.select(*RESULT).collect()) == in_order(plain_matches(docs, items, 4))


def plain_near(docs, items, width, slack, rarest):
    often = Counter(word for _, text in docs for word in plain_words(text))
    for i, text in docs:
        places, found = defaultdict(list), set()
        for at, word in enumerate(plain_words(text)):
            places[word].append(at)
        for name, item in items:
            words = plain_words(item)
            for k in range(max(1, len(words) - width + 1) if words else 0):
                window = words[k : k + width]
                if not all(often[word] for word in window):
                    continue
                order = sorted(enumerate(window), key=lambda p: (often[p[1]], p[0]))[:rarest]
                if any(
                    all(any(abs(p - at + order[0][0] - o) <= slack for p in places[w])
                        for o, w in order[1:])
                    for at in places[order[0][1]]
                ):
                    found.add("" if name is None else str(name))
        yield i, len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()


def test_the_proximity_query_equals_brute_force(spark, passages, monkeypatch):
    docs, items = passages
    given = {
        "documents": framed(spark, docs), "benchmark": framed(spark, items, "item_id long, text string"),
    }
    monkeypatch.setattr(registry, "read_table", lambda _, __, name: given[name])
    found = registry.QUERIES["op10_proximity"](spark, "")
    want = list(plain_near(docs, items, 10, 3, 3))
    assert in_order(found.collect()) == in_order(want)
    assert sum(n for _, n, _ in want) > sum(r[3] for r in plain_matches(docs, items, 10))


def test_decontamination_of_empty_tables(spark, odd, empty):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert decontam.decontaminate(empty, nothing).count() == 0
    assert decontam.decontaminate(odd, nothing).where("contaminated").count() == 0


PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]",
)


def plain_luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0


def plain_spans(text):
    for kind, pattern in enumerate(PATTERNS):
        for found in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", found[0])
            passes = (
                True,
                all(int(x) <= 255 for x in found[0].split(".")) if kind == 1 else False,
                12 <= len(digits) <= 19 and plain_luhn(digits),
                9 <= len(digits) <= 15,
            )[kind]
            if passes:
                yield found.start(), kind, found.end()


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    parts = list("aZ0123456789.@-+_% ()é\n") + [
        "@a.b", ".", "1.2.3.4", "4242424242424242", "+1 (555) 123-4567", "x@y.z", "256.1.1.1",
    ]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 22)))
        assert [tuple(s) for s in pii.base_spans(text)] == sorted(plain_spans(text)), text


@pytest.mark.parametrize("part", ["a", "1", "1.", "+1 ", "a@", "1 ", "A", "Ab ", "a.", "x@y."])
def test_long_runs_take_linear_time(part):
    pii.candidates(part * 100_000)


SECRET = "0123456789abcdef" * 3


@pytest.fixture(scope="module")
def private():
    rng = random.Random(4)
    rows = []
    for i in range(200):
        number = f"{rng.randrange(10**15, 10**16)}"
        rows.append((i, (
            f"note {i} reach me at user{i}@mail.example.com or 10.1.2.{i} call +1 (555) 010-{i:04d}"
            f" number {number} the token = \"{SECRET[i % 7:]}{i:04x}\" ends, Version 2.0."
        )))
    return [*rows, (500, "nothing to see here."), (501, None), (None, ""), (0, rows[0][1])]


def test_every_base_span_stays_and_secrets_are_added(spark, private):
    docs = framed(spark, private)
    rows = pii.find(docs, pii.fit(docs)).collect()
    assert len(rows) == len(private)
    texts = {}
    for i, text in private:
        texts.setdefault(i, text)
    for row in rows:
        base = sorted(plain_spans(texts[row.doc_id]))
        assert row.base == [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base]
        assert set(row.base) <= set(row.spans)
        assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == tuple(
            sum(k == kind for _, k, _ in base) for kind in range(4)
        )
        if row.doc_id is not None and row.doc_id < 200:
            assert any(span.startswith("secret:") for span in row.spans)
        else:
            assert row.spans == []


def test_expectation_maximisation_finds_the_better_voter():
    # Of two voters on one kind the first agrees with a third one, the second is at random.
    rng = random.Random(2)
    patterns = {}
    for _ in range(3000):
        truth = rng.random() < 0.4
        right = 1 if truth else -1
        votes = (
            right if rng.random() < 0.95 else -right, rng.choice((-1, 1)),
            right if rng.random() < 0.9 else -right, right if rng.random() < 0.9 else -right, 0,
        )
        key = (0, *votes, 1, 0, 0, 0)
        patterns[key] = patterns.get(key, 0) + 1
    model = pii.fit_counts(sorted(patterns.items()))
    good, random_one = model.reliability[0, 1, 0, 2], model.reliability[0, 1, 1, 2]
    assert good > 0.9 and abs(random_one - 0.5) < 0.08
    assert abs(model.prior[0] - 0.4) < 0.05


def test_masks_replace_all_spans(spark, private):
    docs = framed(spark, private)
    masked = docs.select("doc_id", pii.masker(pii.fit(docs))(F.col("text")).alias("masked"))
    for row in masked.collect():
        if row.masked is not None:
            assert not list(plain_spans(row.masked)) and SECRET[7:30] not in row.masked
    assert masked.where("masked is null").count() == 1


def test_personal_data_of_an_empty_table(empty):
    assert pii.find(empty, pii.fit(empty)).count() == 0
