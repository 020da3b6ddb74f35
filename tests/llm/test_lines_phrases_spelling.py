"""Line dedup, collocations and spelling variants against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from quadrivium.llm import phrases
from quadrivium.llm.bloom_bits import Bits, filter_of
from quadrivium.llm.line_dedup import dedup_lines
from quadrivium.llm.phrases import collocations, distinct_rows, equal_parts, numbered, split_words, suffixes
from quadrivium.llm.spelling import neighbourhoods, one_edit, reduced_hashes, spelling_variants, symbols_for

CLASHES = "key long, hash string, own int, lost int, n long, seg int, word string, phrase string"


def frame(spark, rows, kind="long"):
    return spark.createDataFrame([(i, t, g, 1, "h", 2, 3, 4, 5, "w", "p") for i, t, g in rows], f"doc_id {kind}, text string, lang string, {CLASHES}")


def lower(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


# -- Bloom filters ---------------------------------------------------------------------------------------------------


def test_bits_have_no_false_negatives():
    some = np.random.default_rng(3).integers(-2**63, 2**63, 50_000)
    bits = Bits(4)
    bits.add(some[:25_000])
    assert bits.has(some[:25_000]).all()
    assert bits.has(some[25_000:]).mean() < 0.01
    assert not len(bits.has(some[:0]))


@pytest.mark.parametrize("size", [64_000_000, 131_072])
def test_broadcast_filter_is_bounded(spark, size):
    some = spark.range(200_000).selectExpr("xxhash64(id) AS h")
    known = filter_of(some, 200_000, size).value
    assert len(known.bits) <= size
    assert known.has(some.toPandas()["h"].to_numpy()).all()


# -- lines -----------------------------------------------------------------------------------------------------------


def plain_lines(rows, least, min_docs):
    holders = defaultdict(set)
    for i, text, _ in rows:
        for line in (text or "").split("\n"):
            key = lower(line.strip(" \t\n\x0b\x0c\r"))
            if len(key) >= least:
                holders[key].add(i)
    rank = lambda i: (i is not None, i)
    keep = {k: max(v, key=rank) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, text, _ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keep.get(lower(x.strip(" \t\n\x0b\x0c\r")), i) == i]
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=repr)


def lines_of(spark, rows, **more):
    return sorted([tuple(r) for r in dedup_lines(frame(spark, rows, more.pop("kind", "long")), **more).collect()], key=repr)


def line_rows(n, seed):
    rnd = random.Random(seed)
    pool = ["A very common line of the corpus", "a very common Line of the corpus\r", "\t common lines, but ÉÀ twice \x0b", "short", "",
            "é" * 20, "é" * 19, "x" * 20, "x" * 19, " wide blank at the head of this", "éÉ" * 12, *(f"line that only some of them have {k}" for k in range(40))]
    rows = [(k, "\n".join(rnd.choice(pool) for _ in range(rnd.randrange(1, 7))), None) for k in range(n)]
    return rows + [(n, None, None), (n + 1, "", None), (n + 2, "\n\n", None)]


@pytest.mark.parametrize("max_bytes", [64_000_000, 0])
def test_lines_equal_plain_python(spark, max_bytes):
    rows = line_rows(120, 1)
    assert lines_of(spark, rows, max_bytes=max_bytes) == plain_lines(rows, 20, 3)


@pytest.mark.parametrize("max_bytes", [64_000_000, 0])
def test_lines_with_null_and_repeated_ids(spark, max_bytes):
    rows = [(None if k % 4 == 0 else k // 3, t, g) for k, (_, t, g) in enumerate(line_rows(60, 2))]
    rows += rows[:10]
    assert lines_of(spark, rows, max_bytes=max_bytes) == plain_lines(rows, 20, 3)


def test_lines_of_text_ids_long_texts_and_empty_tables(spark):
    common = "passage that three of the documents hold"
    rows = [("b", common, None), ("a", f"{common}\n" * 20_000 + "z" * 300_000, None), ("c", f"x\n{common.upper()} ", None), ("d", "y" * 50, None)]
    assert lines_of(spark, rows, kind="string") == plain_lines(rows, 20, 3)
    assert lines_of(spark, [], kind="string") == []
    with pytest.raises(ValueError):
        dedup_lines(frame(spark, rows, "string"), min_docs=1)


# -- phrases ---------------------------------------------------------------------------------------------------------


def plain_phrases(rows, depth, least, top, share):
    counts, totals = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, depth + 1):
                counts[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        good = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in good.items():
            if any(len(q) > len(p) and 100 * b >= share * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in good.items()):
                continue
            score, _, left, right = min((1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r, p.decode(), -a, x, y, totals[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(rows)[:top], 1)]
    return sorted(out)


def phrase_rows(n, seed):
    rnd = random.Random(seed)
    words = ["the", "The", "of", "a", "É", "é", "x\x1cy", "\xa0", "word-s", "b", "c", "d\x85"]
    gaps = [" ", "  ", "\t", " ", " ", " ", ", ", ".", "\n", "\x0b", "!? "]
    return [(k, "".join(rnd.choice(words) + rnd.choice(gaps) for _ in range(rnd.randrange(30))), rnd.choice(["en", "", None, "und"])) for k in range(n)]


@pytest.mark.parametrize("depth,least,share,hot", [(3, 10, 50, 500_000), (3, 4, 90, 20), (4, 3, 60, 30), (2, 2, 50, 0)])
def test_phrases_equal_plain_python(spark, monkeypatch, depth, least, share, hot):
    monkeypatch.setattr(phrases, "HOT", hot)
    monkeypatch.setattr(phrases, "SUFFIXES", 300)
    rows = phrase_rows(200, depth) + [(1, None, "en"), (2, "", "en"), (None, "the of a " * 50, "en"), (3, "the of a " * 50, "en")]
    got = collocations(frame(spark, rows), depth, least, 40, share).collect()
    assert sorted(tuple(r) for r in got) == plain_phrases(rows, depth, least, 40, share)


def test_phrases_of_long_texts_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BATCH", 500)
    rows = [(1, "one two three four. " * 3000, "en"), (2, "no stop at all " * 500, "en")]
    assert sorted(tuple(r) for r in collocations(frame(spark, rows), 3, 10, 5, 50).collect()) == plain_phrases(rows, 3, 10, 5, 50)
    assert collocations(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        collocations(frame(spark, rows), depth=1)


def test_suffix_sort_counts_all_prefixes():
    rnd = np.random.default_rng(5)
    keys = rnd.integers(0, 6, (3000, 4)).astype(np.int32)
    for row, end in zip(keys, rnd.integers(1, 6, 3000)):
        row[end:] = -1
    weight = rnd.integers(1, 5, 3000)
    want = Counter()
    for row, n in zip(keys.tolist(), weight.tolist()):
        for k in range(1, 5):
            if row[k - 1] >= 0:
                want[tuple(row[:k])] += n
    for least in (1, 7, 40):
        got = {}
        for size, at, n in equal_parts(keys, weight, [least] * 4):
            for p, c in zip(at.tolist(), n.tolist()):
                assert tuple(keys[p, :size].tolist()) not in got
                got[tuple(keys[p, :size].tolist())] = c
        assert got == {k: c for k, c in want.items() if c >= least}
    assert list(equal_parts(keys[:0], weight[:0], [1] * 4)) == []


def test_words_and_suffixes():
    (words,) = split_words([b"A b. c", b"", b"D\te"])
    assert words == [b"a", b"b", b"\xff", b"c", b"\xff", b"\xff", b"d", b"e", b"\xff"]
    at, names = numbered(words)
    rows = suffixes(at, 2)
    assert [[names[w] if w >= 0 else None for w in r] for r in rows.tolist()] == [[b"a", b"b"], [b"b", None], [b"c", None], [b"d", b"e"], [b"e", None]]
    for names in (10, 1 << 40):
        rows, n = distinct_rows(np.array([[1, 2], [0, -1], [1, 2]], np.int32), names)
        assert rows.tolist() == [[0, -1], [1, 2]] and n.tolist() == [1, 2]


# -- spelling --------------------------------------------------------------------------------------------------------


def plain_counts(rows, shortest, typo_every):
    out = Counter()
    for i, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{word}".encode())
            if typo_every and h % typo_every == 0:
                word = word[:h % len(word)] + word[h % len(word) + 1:]
            if len(word) >= shortest:
                out[word] += 1
    return out


def plain_edits(word, letters):
    out = {word[:i] + word[i + 1:] for i in range(len(word))}
    out |= {word[:i] + c + word[i + 1:] for i in range(len(word)) for c in letters}
    out |= {word[:i] + c + word[i:] for i in range(len(word) + 1) for c in letters}
    return out - {word}


def plain_variants(rows, shortest, least, ratio, typo_every):
    n = {w: c for w, c in plain_counts(rows, shortest, typo_every).items() if c >= least}
    letters = sorted({c for w in n for c in w})
    near = {w: [x for x in plain_edits(w, letters) if x in n] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def word_rows(n, seed):
    rnd = random.Random(seed)
    stems = ["corpora", "Übung", "éléments", "spelling", "a×b÷cdef", "letters"]
    rows = []
    for k in range(n):
        text = []
        for _ in range(12):
            word = rnd.choice(stems[:1 + int(len(stems) * rnd.random() ** 2)])
            if rnd.random() < 0.4:
                at = rnd.randrange(len(word))
                word = word[:at] + rnd.choice(["", "a", "é", "s"]) + word[at + rnd.choice([0, 1]):]
                if rnd.random() < 0.3:
                    word += rnd.choice("es")
            text.append(word)
        rows.append((k, rnd.choice([" ", "_", "1"]).join(text), "en"))
    return rows


@pytest.mark.parametrize("typo_every,symbols,max_bytes", [(None, None, 64_000_000), (7, 2, 64_000_000), (199, 64, 131_072)])
def test_variants_equal_plain_python(spark, typo_every, symbols, max_bytes):
    rows = word_rows(400, 3) + [(None, "corpora corpora", "en"), (5, None, "en"), (5, "", "en"), (5, "spelling " * 30, None)]
    got = spelling_variants(frame(spark, rows), 5, 2, 3, typo_every=typo_every, symbols=symbols, max_bytes=max_bytes).collect()
    want = plain_variants(rows, 5, 2, 3, typo_every)
    assert any(r[2] not in (r[0], r[1]) for r in want), "the fixture needs chains"
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == want


def test_registered_variants_equal_plain_python(spark, tmp_path):
    from quadrivium.llm import jobs

    rnd = random.Random(9)
    rows = [(k, " ".join(rnd.choice(["variant", "variants", "wariant", "variantes"][:1 + rnd.randrange(4)]) for _ in range(60)), "en") for k in range(60)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = jobs.QUERIES["op11_spelling_variants"](spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[0]) == plain_variants(rows, 6, 5, 5, 199)


def test_very_long_words_and_empty_tables(spark):
    long = "ab" * 20_000
    rows = [(k, f"{long} {long[:-1]} {long}c", "en") for k in range(3)] + [(9, long, "en")]
    got = spelling_variants(frame(spark, rows), 6, 1, 2, symbols=8).collect()
    assert sorted((r.word[-3:], r.n, r.n_near) for r in got) == [("aba", 3, 1), ("abc", 3, 1), ("bab", 4, 2)]
    assert spelling_variants(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(frame(spark, rows), ratio=1)


@pytest.mark.parametrize("symbols,chunk", [(2, 50), (8, 1_000_000), (32, 200)])
def test_neighbourhoods_hold_all_reduced_words_one_edit_away(symbols, chunk):
    words = ["a", "letter", "éà", "abcabcabcabc", "zzzzzz"]
    found = defaultdict(set)
    for rows, hashes in neighbourhoods(words, symbols, chunk):
        for r, h in zip(rows.tolist(), hashes.tolist()):
            found[r].add(h)
    letters = "".join(chr(c) for c in range(97, 97 + symbols))  # one letter for each symbol
    for r, word in enumerate(words):
        same = [e for e in plain_edits(word, letters) if e] + [word]
        assert set(reduced_hashes(same, symbols).tolist()) <= found[r]


def test_one_edit():
    assert one_edit("abc", "abd") and one_edit("abc", "ab") and one_edit("ab", "xab") and one_edit("ab", "aab")
    assert not one_edit("abc", "abc") and not one_edit("abc", "acb") and not one_edit("abc", "a") and not one_edit("abcd", "xbcy")
    assert symbols_for(0) == 8 and symbols_for(200_000) == 16 and symbols_for(2_000_000) == 32
