"""The text operators against plain Python, on hard small tables."""

import collections
import hashlib
import random
import re

import pytest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, words string, lines int, score double"


def table(spark, texts, ids=None):
    """Documents with null columns and columns named like inner ones."""
    rows = [(k, t, None, None, None, "x", 1, None) for k, t in zip(ids or range(len(texts)), texts, strict=True)]
    return spark.createDataFrame(rows, SCHEMA)


COMMON = "a line that several documents share"
LINE_TEXTS = [
    None,
    "",
    "\n\n",
    f"one\n{COMMON}\n",
    f"two\n\t{COMMON.upper()} \r\ntwo",
    f"{COMMON}\n{COMMON}",
    "É" * 25,
    "é" * 25,
    "É" * 25 + "\nx",
    "short\nshort",
    "\n".join([COMMON] * 5000),
]


def test_line_dedup(spark):
    from tagloom.llm.line_dedup import dedup_lines

    texts = LINE_TEXTS + [LINE_TEXTS[3]]
    ids = [*range(len(LINE_TEXTS)), 3]  # a repeated row
    got = collections.defaultdict(set)
    for r in dedup_lines(table(spark, texts, ids)).collect():
        got[r.doc_id].add((r.n_lines, r.n_dropped, r.kept))
    strip = " \t\n\x0b\x0c\r"
    holders = collections.defaultdict(set)
    for k, t in zip(ids, texts, strict=True):
        for line in (t or "").split("\n"):
            holders[line.strip(strip).translate(LOWER)].add(k)
    for k, t in zip(ids, texts, strict=True):
        lines = (t or "").split("\n")
        kept = []
        for line in lines:
            key = line.strip(strip).translate(LOWER)
            if not (len(key) >= 20 and len(holders[key]) >= 3 and k != max(holders[key])):
                kept.append(line)
        assert got[k] == {(len(lines), len(lines) - len(kept), "\n".join(kept))}, k
    assert dedup_lines(table(spark, [])).count() == 0
    assert dedup_lines(table(spark, [COMMON] * 4, [None, None, None, 1])).where("n_dropped > 0").count() == 0


def _shingles(text):
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}


def test_near_duplicates_equal_brute_force(spark):
    """Exact copies, a dense group of near copies, texts of few words, and no words."""
    from tagloom.llm.minhash import near_duplicates

    rnd = random.Random(3)
    base = [f"w{rnd.randint(0, 10**6)}" for _ in range(120)]
    texts = [None, "", " \n", "a b", "A  b", "a b c", "é É", "One two three four five", "one two three four FIVE"]
    for _ in range(150):
        words = base[:]
        for _ in range(rnd.choice([0, 1, 3, 5])):
            words[rnd.randrange(120)] = f"z{rnd.randint(0, 10**6)}"
        texts.append(" ".join(words))
    texts += [" ".join(f"u{rnd.randint(0, 10**6)}" for _ in range(30)) for _ in range(20)]
    texts.append("long " * 30_000)
    got = {r.doc_id: r for r in near_duplicates(table(spark, texts)).collect()}
    sets = [_shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    for k in range(len(texts)):
        assert (got[k].n_shingles, got[k].component_id, got[k].kept) == (len(sets[k]), root(k), root(k) == k), k


def test_near_duplicates_of_nothing_and_repeated_rows(spark):
    from tagloom.llm.minhash import near_duplicates

    assert near_duplicates(table(spark, [])).count() == 0
    rows = near_duplicates(table(spark, ["a b c", "a b c", "a b c", "x"], [5, 5, 2, None])).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in rows) == [(2, 2, True), (5, 2, False)]


LICENSE_TEXTS = [
    None,
    "",
    "cc by-nc CC BY NC cc by nc under the mit license under the MIT-license, Apache License, version 2!",
    "cc by nc " * 300,
    "été under the mit license",
    "Licensed under the GNU General Public License, version 3.",
    "SPDX-License-Identifier: BSD-3-Clause",
    "nothing here",
    "word " * 50_000 + "under the MIT license",
]


def test_near_duplicates_of_clashing_ids(spark):
    """Of two texts of one id the one with the smaller hash counts, whatever the order of rows."""
    from tagloom.llm.minhash import near_duplicates

    one, two = (" ".join(f"{a}{k}" for k in range(60)) for a in "xy")
    rows = [(1, one), (1, two), (2, one + " end"), (3, two + " end"), (3, two + " end")]
    least = min((one, two), key=lambda text: spark.sql("SELECT xxhash64(:t)", args={"t": text}).first()[0])
    want = {1: 1, 2: 1 if least == one else 2, 3: 1 if least == two else 3}
    for given in (rows, rows[::-1]):
        out = near_duplicates(spark.createDataFrame(given, "doc_id long, text string")).collect()
        assert len(out) == 3 and {r.doc_id: r.component_id for r in out} == want


def test_line_dedup_carries_any_column(spark):
    """Carried columns named like inner ones come back as they were."""
    from tagloom.llm.line_dedup import dedup_lines

    rows = [(k, f"{COMMON}\nown {k}", 10 + k, "d", "h", 5) for k in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lines int, drops string, h1 string, at int")
    out = dedup_lines(df, carry=("lines", "drops", "h1", "at")).collect()
    assert sorted((r.doc_id, r.lines, r.drops, r.h1, r.at, r.n_dropped) for r in out) == [(k, 10 + k, "d", "h", 5, int(k < 3)) for k in range(4)]


def test_license_scan(spark):
    from tagloom.llm.license_scan import BASE, rules, scan_licenses

    got = {r.doc_id: r for r in scan_licenses(table(spark, LICENSE_TEXTS)).collect()}
    for k, text in enumerate(LICENSE_TEXTS):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        starts, labels = [], set()
        for phrase, label in BASE.items():
            p = phrase.split()
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    starts.append(i)
                    labels.add(label)
        r = got[k]
        want = (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want, k
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[5].labels == "gpl-3" and got[6].labels == "bsd-3-clause" and got[7].labels == ""
    assert len(rules()) > 300
    assert scan_licenses(table(spark, [])).count() == 0


def _strings(pattern):
    """Strings that match a rule's pattern: every alternative and every optional part with and without."""
    from re import _parser

    def items(nodes):
        out = [""]
        for op, arg in nodes:
            out = [x + y for x in out for y in one(str(op), arg)]
        return out

    def one(op, arg):
        if op == "LITERAL":
            return [chr(arg)]
        if op == "IN":
            return [x for o, a in arg for x in ([chr(a)] if str(o) == "LITERAL" else [chr(a[0])] if str(o) == "RANGE" else ["x"])]
        if op == "SUBPATTERN":
            return items(arg[3])
        if op == "BRANCH":
            return [x for nodes in arg[1] for x in items(nodes)]
        assert op == "MAX_REPEAT"
        lo, hi, nodes = arg
        return sorted({x * n for x in items(nodes) for n in ((0, 1) if (lo, int(hi)) == (0, 1) else (lo,))})

    return items(_parser.parse(pattern))


def test_license_gate(spark):
    """Every match of every rule passes the gate, also where no word of license stands in the text."""
    from tagloom.llm.license_scan import BASE, gate, rules, scan_licenses

    words = gate()
    for r in rules():
        assert all(any(w in x for w in words) for x in _strings(r.pattern)), r
    assert all(any(w in x for w in words) for x in BASE)
    want = {
        "released under the MPL 2.0": "mpl-2",
        "released under MIT": "mit",
        "available under Apache 2.0": "apache-2",
        "published under the BSD 3-Clause": "bsd-3-clause",
        "distributed under the WTFPL": "wtfpl",
        "released under the EUPL 1.2": "eupl-1.2",
        "Proprietary and confidential": "proprietary",
        "without prior written permission": "proprietary",
        "free for personal use": "free-for-use",
        "non-commercial use only": "non-commercial",
        "no rights reserved": "cc0-1",
        "or (at your option) any later version": "or-later",
        "may be used to endorse or promote products derived from this software": "bsd-3-clause",
        "under the terms of its owner": "",
    }
    got = {r.doc_id: r for r in scan_licenses(table(spark, list(want))).collect()}
    for k, (text, labels) in enumerate(want.items()):
        assert got[k].labels == labels and (got[k].score > 0) == bool(labels), text


def test_license_rules_find_their_own_strings(spark):
    """Each rule stands behind words that every match of it holds, and finds strings of its own."""
    from pyspark.sql import functions as F

    from tagloom.llm.license_scan import _detections, rules, scan_licenses

    asked = []
    for r in rules():
        strings = _strings(r.pattern)
        for words in (r.gate, r.keywords):
            assert not words or all(any(w in x for w in words) for x in strings), r
        single = [x for x in strings if x == " ".join(x.split())]
        for x in {single[k * (len(single) - 1) // 4] for k in range(5)}:
            asked.append((f" {' '.join([x, *r.beside.split()])} ", r.label, r.priority, len(x.split())))
    found = spark.createDataFrame(asked, "padded string, label string, priority int, n int").withColumn(
        "hit",
        F.exists(
            _detections(F.col("padded")),
            lambda d: (d["start"] == 0) & (-d["minus_end"] == F.col("n")) & (d["label"] == F.col("label")) & (-d["minus_priority"] == F.col("priority")),
        ),
    )
    assert found.where("not hit").collect() == []
    want = {
        "SPDX-License-Identifier: BSL-1.0": "bsl-1",
        "SPDX-License-Identifier: PSF-2.0": "psf-2",
        "SPDX-License-Identifier: MS-PL": "ms-pl",
        "SPDX-License-Identifier: ODC-By-1.0": "odc-by-1",
        "licensed under the Expat license": "mit",
        "licensed under the Creative Commons Attribution 4.0": "cc-by",
        "Creative Commons Attribution No Derivatives": "cc-by-nd",
        "Creative Commons Attribution-NonCommercial-NoDerivs 3.0": "cc-by-nc-nd",
        "you may not use this file except in compliance with the License, MPL/": "",
    }
    got = {r.doc_id: r.labels for r in scan_licenses(table(spark, list(want))).collect()}
    assert [got[k] for k in range(len(want))] == list(want.values())


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
PII_TEXTS = [
    None,
    "",
    "a@b.c@d.e x_y@z.org_q@w.io é@b.com a.b@c.d.",
    "1.2.3.4.5.6.7.8 256.1.1.1 0000255.1.1.1 1.2.3 00.0.0.0",
    "4111 1111 1111 1111 4111-1111-1111-1111-2 12345678901234567890",
    "+1 (988) 555-2485 +12 +1234567890123456 +1-234-567-8901. +++1 23456789",
    "😀 a@b.co 😀 1.2.3.4\n5500005555555559",
    " ".join(f"u{k}@h{k}.com" for k in range(700)),
]


def _valid(kind, found):
    digits = re.sub("[^0-9]", "", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        twice = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in twice) % 10 == 0
    return kind != "phone" or 9 <= len(digits) <= 15


def test_pii_base_spans(spark):
    from tagloom.llm.pii import digest, scan_pii

    long = ["9" * 60_000, "a" * 60_000 + "@b.com", "@" * 1000]  # long runs end in reasonable time
    got = {r.doc_id: r for r in digest(scan_pii(table(spark, PII_TEXTS + long))).collect()}
    assert len(got) == len(PII_TEXTS) + 3
    for k, text in enumerate(PII_TEXTS):
        spans, counts = [], []
        for kind, pattern in BASE_PATTERNS.items():
            found = [m.span() for m in re.finditer(pattern, text or "") if _valid(kind, m[0])]
            counts.append(len(found))
            spans += [f"{kind}:{a}:{b}" for a, b in found]
        r = got[k]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts, k
        assert r.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert r.spans.split(",")[: len(spans)] == (spans or [""])[: len(spans)]
    assert digest(scan_pii(table(spark, []))).count() == 0


def test_pii_disclosing_terms(spark):
    """A term that stands only beside one entity is marked and removed; a common one is not."""
    from pyspark.sql import functions as F

    from tagloom.llm.pii import redact, scan_pii

    own = [f"the captain zorblax wrote {k}\nfrom zorblax bob@x.org today" for k in range(4)]
    other = [f"the letter came today from somebody {k}" for k in range(60)]
    docs = table(spark, own + other)
    spans = scan_pii(docs)
    got = {r.doc_id: r.term for r in spans.collect()}
    at = own[0].index("zorblax bob")
    assert [(s.start, s.end) for s in got[0]] == [(at, at + 7)] and got[10] == []
    texts = spans.join(docs.select("doc_id", "text"), "doc_id").select("doc_id", redact(F.col("text")).alias("t"))
    clean = {r.doc_id: r.t for r in texts.collect()}
    assert clean[0] == "the captain zorblax wrote 0\nfrom  [EMAIL] today"
    assert clean[10] == other[6]


def test_pii_terms_of_the_whole_text(spark):
    """Short names above and below their e-mail are marked in the whole text, and in a document without the entity."""
    from tagloom.llm.pii import scan_pii

    own = [f"dear all, {k}\nAnn Wu\nreach bob@x.org\n李 / 王伟 greets, ann" for k in range(5)]
    other = [f"dear all, somebody greets, reach {k}" for k in range(60)] + ["Ann came with b@c.org", "Ann, bob@x.org wu"]
    docs = table(spark, own + other)
    got = {r.doc_id: [(s.start, s.end) for s in r.term] for r in scan_pii(docs, scope="text").collect()}
    names = [m.span() for m in re.finditer("Ann|Wu|李|王伟|ann", own[0])]
    assert len(names) == 5 and got[0] == names
    assert got[7] == [] and got[65] == [(0, 3)] and got[66] == [(0, 3), (15, 17)]
    assert scan_pii(table(spark, []), scope="text").count() == 0


def test_pii_long_line_of_entities_and_terms(spark):
    """Terms and entities of one long line are joined only where they can reach the threshold."""
    from tagloom.llm.common import Staged
    from tagloom.llm.pii import disclosing_terms, scan_pii

    log = " ".join(f"u{k}@h.org {chr(97 + k % 26) * 3}{chr(97 + k // 26 % 26) * 3}{chr(97 + k // 676) * 3}" for k in range(3000))
    own = [log] + [f"zorblax bob@x.org {k}" for k in range(3)] + [f"nothing here {k}" for k in range(40)]
    for scope in ("line", "text"):
        staged = Staged(spark, "pii-test")
        assert {tuple(r) for r in disclosing_terms(table(spark, own), staged, scope).collect()} == {(k, 0, "zorblax") for k in (1, 2, 3)}
        sizes = {name: spark.read.parquet(staged.path(name)).count() for name in ("entities", "held", "terms")}
        assert sizes == {"entities": 3003, "held": 3, "terms": 3}
        assert sum(len(r.term) for r in scan_pii(table(spark, own), scope).collect()) == 3


def test_pii_repeated_list_of_entities_and_terms(spark):
    """3,000 addresses and 3,000 names that three documents repeat are one pair of classes; all names are marked."""
    from tagloom.llm.common import Staged
    from tagloom.llm.pii import disclosing_terms

    names = [f"{chr(97 + k % 26) * 3}{chr(97 + k // 26 % 26) * 3}{chr(97 + k // 676) * 3}" for k in range(3000)]
    log = " ".join(f"u{k}@h.org {name}" for k, name in enumerate(names))
    own = [log] * 3 + [f"nothing here {k}" for k in range(60)]
    for scope in ("line", "text"):
        staged = Staged(spark, "pii-test")
        got = {tuple(r) for r in disclosing_terms(table(spark, own), staged, scope).collect()}
        assert got == {(k, 0, name) for k in range(3) for name in names}
        sizes = {name: spark.read.parquet(staged.path(name)).count() for name in ("held", "terms", "some_held", "some_terms", "scored")}
        assert sizes == {"held": 9000, "terms": 9000, "some_held": 3, "some_terms": 3, "scored": 1}


def test_pii_terms_equal_plain_counts(spark, monkeypatch):
    """Random units, entities and terms of many and of few classes, with salts, against plain counting."""
    from math import log2

    from tagloom.llm import pii
    from tagloom.llm.common import Staged

    monkeypatch.setattr(pii, "SALT_ENTITIES", 2)
    rnd = random.Random(11)
    groups = [(f"g{chr(97 + k)}x", f"h{chr(97 + k)}y", [f"a{k}@b.org", f"c{k}@d.org", f"e{k}@f.org"]) for k in range(12)]
    texts = []
    for _ in range(120):
        lines = []
        for one, two, mails in rnd.sample(groups, rnd.choice([0, 0, 1, 2])):
            words = [w for w in (one, two) if rnd.random() < 0.95] + [m for m in mails if rnd.random() < 0.95]
            rnd.shuffle(words)
            lines.append(" ".join(words))
        texts.append("\n".join([*lines, "plain words here"]))
    texts += [texts[0], None, ""]
    for scope in ("line", "text"):
        units = {}
        for d, text in enumerate(texts):
            for u, line in enumerate((text or "").split("\n") if scope == "line" else [text or ""]):
                mails = set(re.findall(r"[a-z0-9]+@[a-z]+\.org", line))
                if mails:
                    units[d, u] = mails, set(re.findall("[a-z]{2,}", re.sub(r"[a-z0-9]+@[a-z]+\.org", " ", line)))
        df = {}
        for d, text in enumerate(texts):
            for w in set(re.findall("[^\\W\\d_]{2,}", text or "")):
                df.setdefault(w, set()).add(d)
        n_e, n_both = {}, {}
        for (d, u), (mails, words) in units.items():
            for e in mails:
                n_e.setdefault(e, set()).add(d)
                for w in words:
                    n_both.setdefault((e, w), set()).add(d)
        pairs = {(e, w) for (e, w), ds in n_both.items() if len(ds) >= 3 and len(ds) >= 0.8 * len(df[w])
                 and log2(len(texts) * len(ds) / (len(n_e[e]) * len(df[w]))) >= 3}
        assert len(pairs) > 10
        if scope == "line":
            want = {(d, u, w) for (d, u), (mails, words) in units.items() for e in mails for w in words if (e, w) in pairs}
        else:
            telling = {w for _, w in pairs}
            want = {(d, 0, w) for d, text in enumerate(texts) for w in set(re.findall("[^\\W\\d_]{2,}", text or "")) if w in telling}
        got = [tuple(r) for r in pii.disclosing_terms(table(spark, texts), Staged(spark, "pii-test"), scope).collect()]
        assert len(got) == len(set(got)) and set(got) == want, scope


@pytest.mark.parametrize("bits", [3, 9])
def test_bpe_equals_the_library(spark, bits):
    import numpy as np
    from tokenizers import Tokenizer

    from tagloom.llm import bpe

    path = bpe.vocabulary_path()
    library = Tokenizer.from_file(path)
    rnd = random.Random(bits)
    letters = list("aeiouE Éé \n\t.,!'s 's'll 12３́ ßİKſ😀漢<|endoftext|>Σς")
    texts = ["", "<|endoftext|>x <|STARTOFTEXT|> <|startoftext|>", "The the the. THE, don't", "ab" * 2000]
    texts += ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 300))) for _ in range(150)]
    encoder = bpe.Encoder(path)
    chunked = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        edges = [0, *bpe.cuts(data, bits).tolist(), len(data)]
        chunked.append([t.encode()[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)])
    for t, (ids, decoded) in zip(texts, encoder.texts(chunked), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert decoded.decode() == library.decode(want, skip_special_tokens=False), t


def _whole(encoder, texts):
    return [(ids, decoded.decode()) for ids, decoded in encoder.texts([[t.encode()] for t in texts])]


def test_bpe_pieces_equal_the_library(spark):
    """Every character whose runs are cut into pieces here, alone and beside others, and runs that are not cut."""
    import numpy as np

    from tagloom.llm import bpe

    encoder = bpe.Encoder(bpe.vocabulary_path())
    assert encoder.units.plain
    own = [chr(k) for k in range(0x2100) if not bpe._OTHER.search(chr(k))]
    assert {"\0", "\x1c", "\x7f", "É", "Ā", "Ё", "’"} <= set(own) and not {"\x85", "\xa0", "İ", "\u0301", "Σ", "\u2028"} & set(own)
    rnd = random.Random(7)
    texts = [form.replace("{}", c) for c in own for form in ("{}", "a{}B", "{}{}'S", "7{}!", "x {} y")]
    texts += ["".join(rnd.choice(own) for _ in range(40)) for _ in range(300)]
    texts += ["e\u0301É E\u0301.", "дом Й и\u0306", "ΑΣ, ΑΣ", "İı “don’t” DON'T", "a\x85b a\xa0b\u2028c", "a<|endoftext|>É <| |>", "漢字か\u3099x 1２½"]
    library = encoder.units.tokenizer
    for t, (ids, decoded) in zip(texts, _whole(encoder, texts), strict=True):
        want = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, ascii(t)
        assert decoded == library.decode(want, skip_special_tokens=False), ascii(t)


def test_bpe_encodes_a_piece_once_whatever_stands_beside_it(monkeypatch):
    """Capitals, accents and marks take no further call of the whole tokenizer (F1: 968 CPU seconds a GB)."""
    from tagloom.llm import bpe

    class Counted:
        calls = 0

        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            return getattr(self.inner, name)

        def encode(self, *args, **options):
            Counted.calls += 1
            return self.inner.encode(*args, **options)

    path, load = bpe.vocabulary_path(), bpe._tokenizer
    monkeypatch.setattr(bpe, "_tokenizer", lambda path: Counted(load(path)))
    encoder = bpe.Encoder(path)
    got = _whole(encoder, ["Été, été!! ÉTÉ&&& “été” дом. Дом–дом don't DON'T 14.25", "İstanbul istanbul"])
    assert len(got) == 2 and all(ids for ids, _ in got)
    assert Counted.calls == 1  # İ has a lower case of two characters


def test_bpe_caches_stay_bounded(monkeypatch):
    """Texts with more distinct pieces and chunks than are kept are encoded alike."""
    from tagloom.llm import bpe

    texts = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}x{j}" for k in range(300)) for j in range(5)]
    want = _whole(bpe.Encoder(bpe.vocabulary_path()), texts)
    monkeypatch.setattr(bpe, "KEPT_UNITS", 50)
    monkeypatch.setattr(bpe, "KEPT_CHUNKS", 2)
    encoder = bpe.Encoder(bpe.vocabulary_path())
    assert _whole(encoder, texts) == want
    assert len(encoder.units) <= 51 and len(encoder.chunks) <= 3


def test_bpe_query(spark):
    from tagloom.llm.bpe import encode_digests

    docs = table(spark, [None, "", "hello world", "hello world"], [1, 2, 3, 3])
    got = sorted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in encode_digests(docs).collect())
    empty = hashlib.sha256(b"").hexdigest()
    assert got[:2] == [(1, 0, empty), (2, 0, empty)] and got[2] == got[3] and got[2][1] == 2
    assert encode_digests(table(spark, [])).count() == 0


WORKER = """
import os, random, re
import pyarrow as pa
from tagloom.llm import bpe
from tagloom.llm.common import lean

def private():
    with open("/proc/self/smaps_rollup") as file:
        return sum(map(int, re.findall(r"Pss_(?:Anon|Shmem):\\s+(\\d+)", file.read()))) // 1024

rnd = random.Random(5)
texts = [" ".join(f"{rnd.randint(0, 9**7)}-{rnd.choice('éßa')}x" for _ in range(400)) for _ in range(60)]
batch = pa.RecordBatch.from_arrays([pa.array(range(60), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
task = lean(bpe._encoded(bpe.vocabulary_path()))
threads, first = len(os.listdir("/proc/self/task")), None
for k in range(6):
    got = [b.to_pydict() for b in task(iter([batch]))]
    first = first or (got, private())
    assert got == first[0]
print(len(os.listdir("/proc/self/task")) - threads, private() - first[1])
"""


def test_bpe_tasks_of_one_worker_keep_no_memory():
    """Six tasks of a Python worker take no threads of their own and leave no more memory behind than one."""
    import os
    import subprocess
    import sys

    if not os.path.exists("/proc/self/smaps_rollup"):
        pytest.skip("memory can't be read here")
    path = os.pathsep.join(p for p in sys.path if p)
    out = subprocess.run([sys.executable, "-c", WORKER], env=os.environ | {"PYTHONPATH": path}, capture_output=True, text=True, timeout=200)
    assert out.returncode == 0, out.stderr[-2000:]
    threads, more_mb = map(int, out.stdout.split()[-2:])
    assert threads == 0 and more_mb < 40, (threads, more_mb)


def test_components_of_few_edges_take_no_rounds(spark, monkeypatch):
    """A table that one task holds is written once; rounds of shuffles give the same components of it."""
    from tagloom.llm import components as module
    from tagloom.llm.common import Staged

    class Counted(Staged):
        names = ()

        def write(self, df, name):
            self.names += (name,)
            return super().write(df, name)

    rnd = random.Random(11)
    edges = [(k, k + 1) for k in range(40)] + [(rnd.randint(100, 400), rnd.randint(100, 400)) for _ in range(250)]
    edges += [(7, 7), (500, 500), (None, 3), (2**40, -5), (2**40, -5), (-5, 2**40), (39, 2**41)]
    given = spark.createDataFrame(edges, "a long, b long").repartition(5)
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    want = sorted((x, root(x)) for x in parent)
    staged = Counted(spark, "few")
    assert sorted(map(tuple, module.components(given, staged).collect())) == want
    assert staged.names == ("cc-0",)
    assert module.components(given.limit(0), Counted(spark, "none")).count() == 0
    monkeypatch.setattr(module, "ONE_TASK", 0)
    staged = Counted(spark, "rounds")
    assert sorted(map(tuple, module.components(given, staged).collect())) == want
    assert len(staged.names) > 1
