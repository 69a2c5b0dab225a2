import hashlib
import random

import numpy as np
import pyarrow as pa

from salesops.llm import fingerprints as fp
from salesops.llm.textarrays import pieces
from tests.llm.conftest import ODD, SMALL


def marks(texts):
    return [f for p in pieces(pa.array(texts, pa.large_string())) for f in fp.fingerprints(p)]


def one(text):
    return marks([text])[0]


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(row[k + 1], new[-1]))
        row = new
    return row[-1]


def test_common_subsequence():
    draw = random.Random(2)
    for _ in range(200):
        a, b = ("".join(draw.choice("abcd") for _ in range(draw.randint(0, 20))) for _ in range(2))
        assert fp._common_subsequence(a, b) == common(a, b)


def test_place_and_edits():
    draw = random.Random(3)
    text = " ".join("".join(draw.choice("etaoin") for _ in range(5)) for _ in range(700))
    assert marks(["x", text, "", text]) == [one("x"), one(text), one(""), one(text)]
    other = " ".join("".join(draw.choice("shrdlu") for _ in range(5)) for _ in range(700))
    changed = text[:2000] + "something else" + text[2030:]
    assert fp.likeness(one(text), one(changed)) > 0.85
    assert fp.likeness(one(text), one(other)) < 0.2
    assert 0.3 < fp.likeness(one(text), one(fp.edited(text, other))) < 0.8
    assert fp.likeness(one(text), one(text)) == 1 == fp.likeness(one(""), one(""))
    assert fp.likeness(one(text), one(text + " " + other)) > 0.3  # levels one apart are compared


def chained(rows, ties):
    order = sorted(rows, key=lambda r: (-(1 << 63) if r[0] is None else r[0], ties[r[1] or ""]))
    texts = [t or "" for _, t in order]
    result = []
    for k, (key, _) in enumerate(order):
        following = texts[(k + 1) % len(texts)]
        changed = fp.edited(texts[k], following)
        a, b, c = one(texts[k]), one(changed), one(following)
        digest = hashlib.sha256(changed.encode()).hexdigest()
        result.append((key, len(texts[k]), digest, a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(result, key=str)


def scrambled(x):
    x = (x + 0x9E3779B97F4A7C15) % 2**64
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 % 2**64
    x = (x ^ x >> 27) * 0x94D049BB133111EB % 2**64
    return x ^ x >> 31


def hashed(run):
    return scrambled(sum(scrambled(b) * pow(0x9E3779B97F4A7C15, k, 2**64) for k, b in enumerate(run)) % 2**64)


def plain(text):
    """The fingerprint, byte by byte and chunk by chunk."""
    data = text.encode()
    if not data:
        return "2::"
    ones = []
    for k in range(len(data)):
        bits = f"{hashed(data[max(k - 6, 0) : k + 1]):064b}"
        ones.append(len(bits) - len(bits.rstrip("1")))

    def cuts(level):
        return [k + 1 for k, n in enumerate(ones) if n >= level]

    def signature(level, longest):
        edges = [0, *(c for c in cuts(level) if c < len(data)), len(data)]
        chunks = [data[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]
        joined = -(-len(chunks) // longest) if longest == 64 or len(chunks) >= 1.5 * longest else 1
        groups = [b"".join(chunks[k : k + joined]) for k in range(0, len(chunks), joined)]
        if len(groups) > longest:
            groups = [*groups[: longest - 1], b"".join(groups[longest - 1 :])]
        signs = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
        return "".join(signs[hashed(g) >> 40 & 63] for g in groups)

    level = max(2, (len(data) // 64).bit_length())
    while level > 2 and len(cuts(level)) < 32:
        level -= 1
    while len(cuts(level)) >= 64 and len(cuts(level + 1)) >= 16:
        level += 1
    return f"{level}:{signature(level, 64)}:{signature(level + 1, 32)}"


def test_signatures_against_a_plain_version():
    draw = random.Random(5)
    texts = [t or "" for _, t in ODD if len(t or "") < 1000] + ["x" * 700, "Zażółć 日本語 " * 40]
    for size in (1, 6, 7, 8, 63, 64, 65, 200, 500, 1500, 4000):
        texts += ["".join(draw.choice(letters) for _ in range(size)) for letters in ("ab \n", "abcdefghijklmnopqrstuvwxyz  é日")]
    for size in (5, 23, 60):
        line = "".join(draw.choice("abcdefghij ") for _ in range(size)) + "\n"
        texts.append(line * (5000 // size))
    draw.shuffle(texts)
    assert marks(texts) == [plain(t) for t in texts]


def checked(documents):
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    ties = {r.text or "": r.tie for r in documents.selectExpr("text", "xxhash64(coalesce(text, '')) AS tie").collect()}
    assert sorted((tuple(r) for r in fp.with_neighbours(documents).collect()), key=str) == chained(rows, ties)


def test_neighbours(spark, odd, none):
    checked(odd)
    assert fp.with_neighbours(none).count() == 0
    checked(odd.where("doc_id = 9"))
    checked(spark.read.parquet(f"{SMALL}/documents.parquet"))


def test_neighbours_under_one_hot_key(spark):
    """A third of all rows share an id, others have none: their texts spread over ranges and keep the order."""
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    hot = documents.selectExpr("CASE WHEN doc_id % 3 = 0 THEN 7 WHEN doc_id % 3 = 1 THEN doc_id END AS doc_id", "text")
    checked(hot)
    pairs = [(-1, 5), (7, -9), (7, 0), (7, 4), (8, 1)]
    rows = [(-2, 0), (-1, 5), (0, 0), (7, -10), (7, -9), (7, -1), (7, 3), (7, 4), (7, 9), (8, 0), (8, 1), (9, 0)]
    parts = spark.createDataFrame(rows, "order long, tie long").coalesce(1).select("order", "tie", fp._part_of(pairs).alias("part"))
    want = [max(sum(p <= r for p in pairs) - 1, 0) for r in rows]
    assert [r.part for r in parts.collect()] == want == [0, 0, 0, 0, 1, 1, 2, 3, 3, 3, 4, 4]


def test_fingerprint(odd):
    assert sorted(map(str, fp.fingerprint(odd).collect())) == sorted(
        f"Row(doc_id={k}, fingerprint={one(t or '')!r})" for k, t in ODD
    )


def test_neighbours_are_far_apart_and_edits_near(spark):
    rows = fp.with_neighbours(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert np.mean([r.near_edited for r in rows]) > 0.45 and np.mean([r.near_next for r in rows]) < 0.05


def test_repeated_lines_are_signed_to_their_end():
    """One line many times: replacing the last half, by other text, moves the likeness by about as much."""
    draw = random.Random(11)

    def prose(words):
        return " ".join("".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(words)) + "\n"

    for _ in range(20):
        line = prose(9)
        for lines in (118, 150, 183):
            half = line * (lines // 2)
            assert fp.likeness(one(line * lines), one(half + prose(9 * (lines - lines // 2)))) < 0.75
