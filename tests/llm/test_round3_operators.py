"""Prefix trie, fingerprints and divergence audit against plain Python on hard small tables."""

import collections
import hashlib
import random
import re
import struct
import zlib

import pytest
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# ---------------------------------------------------------------- prefix trie

TURNS = "conv_id long, turn long, role string, text string, block long, n1 string, weight int"


def conversations(spark, rows):
    """Conversations with columns named like inner ones."""
    return spark.createDataFrame([(*r, 7, "x", None) for r in rows], TURNS)


def plain_trie(rows):
    turns = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            order = (turn is not None, turn or 0, role.encode(), text[:32].encode(), hashlib.md5(text.encode()).hexdigest())
            turns[c].append((order, (role, text)))
    own = {c: [t for _, t in sorted(ts)] for c, ts in turns.items()}
    paths = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + ts[h:]
    members = collections.defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    kids = collections.Counter(node[:-1] for node in members if node)
    out = []
    for node, convs in members.items():
        under = [other for other in members if other[: len(node)] == node]
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.append(
            (
                min(convs),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(convs),
                kids[node],
                sum(not kids[other] for other in under),
                sum((len(members[o]) - 1) * len(WORD.findall(o[-1][1])) for o in under if o),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(out, key=str)


def trie_rows(spark, rows):
    from tagloom.llm.prefix_trie import prefix_trie

    return sorted((tuple(r) for r in prefix_trie(conversations(spark, rows)).collect()), key=str)


def test_prefix_trie_odd_rows(spark):
    rows = [
        (0, None, None, None),
        (0, 1, "user", "hello there"),
        (0, 2, "bot", "  "),
        (0, 2, "bot", "a\tb c"),
        (0, 2, "bot", "a\tb c"),  # a repeated row
        (1, 5, "user", "hello there"),
        (2, 5, "user", "hello there"),
        (3, None, "", ""),
        (3, None, None, "x" * 40 + "b"),
        (3, None, None, "x" * 40 + "a"),  # equal turns
        (25, 0, "user", "no base here"),
        (26, 0, "user", "no base here"),
        (None, 0, "user", "no id"),
        (41, 1, "user", "w " * 3000),
        (42, 1, "user", "w " * 3000),
        (5000, 1, "user", "another shard"),
        (5000, 2, "user", "ends later"),
    ]
    assert trie_rows(spark, rows) == plain_trie(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_prefix_trie_random(spark, seed, monkeypatch):
    """Many shared prefixes, over several shards and bands."""
    from tagloom.llm import prefix_trie as module

    monkeypatch.setattr(module, "CONVS", 7)
    monkeypatch.setattr(module, "BAND", 3)
    rng = random.Random(seed)
    rows = []
    for c in range(0, 130):
        if rng.random() < 0.8:
            words = ["a", "b"] if rng.random() < 0.9 else ["a", "b c", "d e f"]
            length = rng.choice([0, 1, 2, 3, 4, 6, 9, 12])
            rows += [(c, t, "u" if t % 2 else None, rng.choice(words[: 1 + (t > 2)])) for t in range(length)]
    rng.shuffle(rows)
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_prefix_trie_of_one_long_conversation(spark):
    """One conversation with nearly all rows, of which another one repeats a part."""
    rows = [(20, t, "u", f"turn {t}") for t in range(700)] + [(40, t, "u", f"turn {t}") for t in range(500)]
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_prefix_trie_of_nothing(spark):
    assert trie_rows(spark, []) == []
    assert trie_rows(spark, [(None, 1, "a", "b")]) == []
    assert trie_rows(spark, [(7, 1, "a", "b c")]) == plain_trie([(7, 1, "a", "b c")])


# --------------------------------------------------------------- fingerprints

DOCS = "doc_id long, text string, lang string, source string, n_chars long, tie string, sketch int, start string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, None, "x", 1, "y") for i, t, lang, source in rows], DOCS)


def signed(value):
    return struct.unpack("<q", struct.pack("<Q", value))[0]


def plain_shingles(text):
    words = [b for b in WORD.findall((text or "").translate(LOWER))]
    hashes = [0] * 4 + [xxhash.xxh64(w.encode(), 42).intdigest() for w in words]
    out = set()
    for k in range(len(hashes) - 4):
        seed = 42
        for h in hashes[k : k + 5]:
            seed = xxhash.xxh64(struct.pack("<Q", h), seed).intdigest()
        out.add(signed(seed))
    return out if words else set()


def plain_resemblance(a, b):
    a, b = sorted(a)[:64], sorted(b)[:64]
    least = sorted({*a, *b})[:64]
    return len({*a} & {*b} & {*least}) / len(least) if least else 1.0


FINGER_TEXTS = [
    None,
    "",
    " \n\t",
    "one",
    "Two words",
    "É é É and A a A, code points: 𝕏𝕐ℤ",
    " ".join(f"w{k}" for k in range(400)),
    " ".join(f"w{k}" for k in range(300)) + " and a new end " * 9,
    "again " * 5000,
    "x" * 100_000,
]


def test_fingerprints(spark):
    from tagloom.llm.fingerprints import compare_edited, digest

    ids = [3, 17, -4, 8, 90, 41, 55, 54, 1000, 7]
    given = dict(zip(ids, FINGER_TEXTS, strict=True))
    rows = [(i, t, None, None) for i, t in given.items()]
    rows += [rows[6], (None, "no id", None, None)]  # a repeated row, a row without an id
    compared = compare_edited(documents(spark, rows))
    got = sorted((r.asDict() for r in digest(compared).collect()), key=lambda r: r["doc_id"])
    order = sorted(given, reverse=True)
    want = []
    for at, i in enumerate(order):
        text, after = given[i] or "", given[order[(at + 1) % len(order)]] or ""
        tail = len(text) // 3
        edited = text[: len(text) - tail] + after[:tail]
        a, b, c = plain_shingles(text), plain_shingles(edited), plain_shingles(after)
        for _ in range(2 if i == 55 else 1):
            want.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), plain_resemblance(a, b), plain_resemblance(a, c)))
    assert [(r["doc_id"], r["n_chars"], r["edited_sha256"], r["near_edited"], r["near_next"]) for r in got] == sorted(want)
    for r in got:
        n = len(plain_shingles(given[r["doc_id"]]))
        assert r["n_shingles"] == n if n < 64 else abs(r["n_shingles"] / n - 1) < 0.5
        assert 0 <= r["contained_edited"] <= 1
    same = collections.defaultdict(set)
    for r in got:
        same[given[r["doc_id"]] or ""].add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in same.values())
    assert len({next(iter(p)) for p in same.values()}) == len(same) - 1  # the empty and the blank text are alike


def test_fingerprints_of_few_rows(spark):
    from tagloom.llm.fingerprints import compare_edited, digest

    assert digest(compare_edited(documents(spark, []))).collect() == []
    (one,) = digest(compare_edited(documents(spark, [(5, "abcdef ghi", None, None)]))).collect()
    assert one["edited_sha256"] == hashlib.sha256(b"abcdef abc").hexdigest() and one["near_next"] == 1.0


def test_next_document_of_clashing_ids(spark):
    """Of two texts with the next id the one with the smaller hash counts, whatever the order of rows."""
    from tagloom.llm.fingerprints import compare_edited

    rows = [(2, "abcdefghi", None, None), (1, "first one", None, None), (1, "other one", None, None)]
    seen = set()
    for given in (rows, rows[::-1]):
        out = compare_edited(documents(spark, given)).collect()
        assert len(out) == 3
        seen.add(tuple(sorted(r["edited"] for r in out)))
    least = min(("first one", "other one"), key=lambda t: signed(xxhash.xxh64(t.encode(), 42).intdigest()))
    assert len(seen) == 1 and "abcdef" + least[:3] in next(iter(seen))


def test_merged_sketches(spark):
    from tagloom.llm.fingerprints import merged, sketches

    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=rng.randrange(60))), "en" if i % 3 else None, None) for i in range(90)]
    rows += [(200, None, "none", None), (201, "", "none", None)]
    docs = documents(spark, rows).drop("sketch")
    got = {r["lang"]: r["sketch"] for r in merged(sketches(docs), "lang").collect()}
    want = collections.defaultdict(set)
    for _, text, lang, _ in rows:
        want[lang] |= plain_shingles(text)
    assert got == {lang: sorted(hashes)[:64] for lang, hashes in want.items()}


# ---------------------------------------------------------- divergence audit

TERM = re.compile("[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+")


def plain_audit(rows, min_docs):
    groups = collections.defaultdict(collections.Counter)
    docs = collections.defaultdict(collections.Counter)
    for _, text, lang, source in rows:
        words = TERM.findall((text or "").translate(LOWER))
        groups[lang or "", source or ""].update(words)
        docs[lang or ""].update(set(words))
    kept = {lang: {t for t, n in c.items() if n >= min_docs} for lang, c in docs.items()}
    prices = {}
    whole = collections.defaultdict(collections.Counter)
    for (lang, _), c in groups.items():
        whole[lang].update(c)
    for key, c in [*groups.items(), *((lang, c) for lang, c in whole.items())]:
        lang = key if isinstance(key, str) else key[0]
        v, n = len(kept[lang]), sum(c[t] for t in kept[lang])
        prices[key] = {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * v) for t in kept[lang]}
    out = []
    for lang, source in groups:
        mine = prices[lang, source]
        pairs = [
            (-sum(abs(mine[t] - prices[lang, other][t]) for t in mine), other.encode())
            for of, other in groups
            if of == lang and other != source
        ]
        terms = [(prices[lang][t] - mine[t], t.encode()) for t in mine if groups[lang, source][t] and mine[t] > prices[lang][t]]
        for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:50])):
            out += [(lang, source, part, item.decode(), -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(512, 16), (3, 2)])
def test_divergence(spark, monkeypatch, blocks):
    from tagloom.llm import source_divergence as module

    for name, value in zip(("TERMS", "SOURCES"), blocks, strict=True):
        monkeypatch.setattr(module, name, value)
    rng = random.Random(9)
    vocabulary = [f"{a}{b}" for a in "abcdefghijklm" for b in "éßxyz"] + ["ÀB", "Zz"]
    rows = []
    for i in range(600):
        lang = rng.choice(["en", "de", None])
        source = rng.choice([None, "web", "Web", "news", "books", "wiki", "émile", "x1"])
        picked = rng.choices(vocabulary, weights=range(1, len(vocabulary) + 1), k=rng.randrange(30))
        rows.append((i, rng.choice([" ", "-", "1_"]).join(picked), lang, source))
    rows += [(1, None, "en", "silent"), (1, None, "en", "silent"), (None, "rare words", "fr", "a"), (2, "\n", "fr", "b"), (3, "", "it", "a")]
    rows += [(4, "the " * 40_000, "en", "web")]
    got = sorted(tuple(r) for r in module.audit(documents(spark, rows)).collect())
    assert got == plain_audit(rows, 30)
    assert {r[2] for r in got if r[0] == "en"} == {"pair", "term"}


def test_counting_gives_out_what_it_holds(monkeypatch):
    """A task that holds few entries at a time counts the same."""
    import pyarrow as pa

    from tagloom.llm import source_divergence as module

    texts = [" ".join(f"t{chr(97 + k % 7)}" for k in range(n)) for n in range(40)]
    batch = pa.RecordBatch.from_pydict({"lang": ["en"] * 40, "source": ["a", "b"] * 20, "text": texts})

    def summed():
        total = collections.Counter()
        parts = 0
        for out in module._counted(iter([batch])):
            parts += 1
            for r in out.to_pylist():
                total[r["source"], r["term"], "n"] += r["n"]
                total[r["source"], r["term"], "docs"] += r["docs"]
        return total, parts

    whole, one = summed()
    monkeypatch.setattr(module, "HELD", 3)
    pieces, many = summed()
    assert whole == pieces and one == 1 < many


def test_divergence_of_nothing(spark):
    from tagloom.llm.source_divergence import audit

    assert audit(documents(spark, [])).collect() == []
    assert audit(documents(spark, [(1, None, None, None)])).collect() == []
