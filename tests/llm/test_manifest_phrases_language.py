"""Operators 11 to 13 on small tables with nulls, empty and very long texts, ties, repeated rows and clashing column names."""
from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from parley.llm import collocations, langid, merkle

DOCS = "doc_id long, source string, lang string, n_chars long, text string, tree long, h string, rank long, path int, key string, phrase string, f long"
EXTRA = (7, "h", 1, 2, "k", "p", 3)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], DOCS)


# --- 11 -------------------------------------------------------------------------------------------------------------

def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def brute_manifest(rows):
    def climb(nodes):
        """nodes -> (top, [(position, run) of every level] for each node)."""
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for i, p in enumerate(paths):
                run = nodes[at[i] // 16 * 16:at[i] // 16 * 16 + 16]
                p.append((at[i] % 16, run))
            nodes = [sha(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
            at = [a // 16 for a in at]
        return nodes[0], paths
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    done = {}
    for name in names:
        mine = sorted(groups[name], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        done[name] = (mine, *climb([leaf_of(r) for r in mine]))
    root, over = climb([done[n][1] for n in names])
    out = []
    for name, up in zip(names, over, strict=True):
        mine, subroot, paths = done[name]
        for r, path in zip(mine, paths, strict=True):
            full = path + up
            proof = "".join("".join(run[:p] + run[p + 1:]) for p, run in full)
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = text.translate(brute.ASCII_LOWER)
            h = leaf_of((*r[:4], text))
            for p, run in full:
                h = sha(*run[:p], h, *run[p + 1:])
            out.append((r[0], leaf_of(r), subroot, root, sha(proof), h, h == root))
    return out


def manifest_rows():
    r = random.Random(5)
    rows = [(i, "hot", "en", i, f"Text {i} ÄÖ " + "Word " * r.randint(0, 4)) for i in range(4200)]  # three passes with 256 leaves in a block
    rows += [(5000 + i, "sixteen", None, None, "A") for i in range(16)] + [(6000 + i, "seventeen", "de", 0, None if i % 2 else "") for i in range(17)]
    rows += [(7000, "lone", "fr", 1, "X" * 300_000), (None, None, None, None, None), (None, "", "", 0, ""), (None, "", "", 0, "B"), (1, "ünïcode", "es", 4, "Ab")]
    rows += [(8000, "twins", "en", 1, "Same Text")] * 20 + [(8000, "twins", "en", 1, "other")]
    return rows + [(9000 + i, f"s{i:03d}", "en", 1, "T") for i in range(300)]  # a tree of groups with two passes


def test_manifest_against_plain_definition(spark):
    rows = manifest_rows()
    got = [tuple(x) for x in merkle.verified(frame(spark, rows)).collect()]
    key = repr
    assert sorted(got, key=key) == sorted(brute_manifest(rows), key=key)
    assert 0 < sum(not x[-1] for x in got) < len(got)


@pytest.mark.parametrize("digits", [1, 3])
def test_manifest_does_not_depend_on_the_block_size(spark, digits):
    rows = manifest_rows()[4000:]
    docs = frame(spark, rows)
    cols = ["doc_id", "leaf", "subroot", "root", "path"]
    one, other = (sorted((repr(r) for r in merkle.manifest(docs, digits=d).select(*cols).collect())) for d in (digits, 2))
    assert one == other


def test_manifest_proofs_hold_without_the_table(spark):
    """A path alone, with the leaf, gives the root in plain Python."""
    for r in merkle.manifest(frame(spark, manifest_rows()[4100:4260])).collect():
        h = r.leaf
        for pos, run in r.path:
            assert run[pos] == h and len(run) <= merkle.FAN
            h = sha(*run)
        assert h == r.root


def test_manifest_of_an_empty_table_and_of_one_row(spark):
    docs = frame(spark, [(3, "only", "en", 1, "T")])
    assert merkle.verified(docs.filter("false")).collect() == []
    row = merkle.verified(docs).first()
    assert row.leaf == row.subroot == row.root == row.folded_root and row.proof_sha256 == sha("")


# --- 12 -------------------------------------------------------------------------------------------------------------

def brute_collocations(rows, threshold, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        pieces = [[]]
        for word in brute.re.findall(r"[.,;:!?\n\x0b\x0c\r]|[^.,;:!?\n\x0b\x0c\r\x20\x09]+", (text or "").translate(brute.ASCII_LOWER)):
            if word in ".,;:!?\n\x0b\x0c\r":
                pieces.append([])
            else:
                pieces[-1].append(word)
        for w in pieces:
            n[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    f[lang, tuple(w[i:i + m])] += 1
    often = {k: v for k, v in f.items() if v >= threshold}
    longer = Counter()
    for (lang, w), a in often.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                longer[lang, w[i:i + m]] = max(longer[lang, w[i:i + m]], a)
    found = defaultdict(list)
    for (lang, w), a in often.items():
        if len(w) > 1 and not 100 * longer[lang, w] >= 100 * a:
            score, _, left, right = min((1000 * a * n[lang] // (often[lang, w[:k]] * often[lang, w[k:]]), k, often[lang, w[:k]], often[lang, w[k:]])
                                        for k in range(1, len(w)))
            found[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, rows in found.items() for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top]))


def phrase_rows():
    r = random.Random(9)
    vocab = ["red", "Fox", "ünder", "the", "old", "bridge", "a", "na", "😀x", "can't", "x" * 300]
    rows = []
    for _ in range(150):
        words = [r.choice(vocab) for _ in range(r.randint(0, 60))]
        text = "".join(w + r.choice([" ", " ", "  ", "\t", ", ", ".\n", "\r", " \x0b", "\x1c"]) for w in words) + r.choice(["The Red Fox", "na na na na na na", ""])
        rows.append((r.choice(["en", "en", "de", None, "und", ""]), text))
    return rows + [("en", None), (None, ""), ("de", " \t.,"), ("long", "up the hill " * 40_000), *[("en", "the red fox jumps over the old bridge")] * 40]


@pytest.mark.parametrize("threshold, top", [(12, 2000), (5, 7)])
def test_collocations_against_plain_counts(spark, threshold, top):
    rows = phrase_rows()
    docs = frame(spark, [(i, None, lang, 1, text) for i, (lang, text) in enumerate(rows)])
    got = sorted(tuple(x) for x in collocations.collocations(docs, threshold=threshold, top=top).collect())
    assert got == brute_collocations(rows, threshold, top) and len({x[0] for x in got}) >= 4


def test_collocations_with_a_full_filter(spark, monkeypatch):
    """Neither a filter that lets all pass nor a small one changes a count."""
    rows = phrase_rows()[:60]
    docs = frame(spark, [(i, None, lang, 1, text) for i, (lang, text) in enumerate(rows)])
    monkeypatch.setattr(collocations, "_filter_bits", lambda kept, into: np.full(len(into), 255, np.uint8))
    assert sorted(tuple(x) for x in collocations.collocations(docs, threshold=8).collect()) == brute_collocations(rows, 8, 2000)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(frame(spark, []).filter("false")).collect() == []


def test_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(10 ** 11, 10 ** 13, 10 ** 12, 3 * 10 ** 12)], "a long, n long, l long, r long")
    text = "(1000bd * cast(a as decimal(17,0)) * cast(n as decimal(17,0))) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    assert big.select(F.expr(text)).first()[0] == 1000 * 10 ** 24 // (3 * 10 ** 24)


@pytest.mark.parametrize("seed", range(4))
def test_summaries_keep_every_frequent_item(seed):
    r = np.random.default_rng(seed)
    parts = [r.zipf(1.2, 3000).astype(np.uint64) % np.uint64(1 << 40) for _ in range(30)]
    threshold = 50
    s = collocations.Summary(sum(map(len, parts)), threshold)
    for p in parts:
        g, n = np.unique(p, return_counts=True)
        s.add(g, n)
        s.merge()
        assert len(s.gram) <= s.capacity
    g, n = np.unique(np.concatenate(parts), return_counts=True)
    assert set(g[n >= threshold].tolist()) <= set(s.survivors().tolist())
    assert s.taken > 0


# --- 13 -------------------------------------------------------------------------------------------------------------

SYLLABLES = {"aa": "ka lo mi tu re so".split(), "bb": "sch ung keit ver ö ß".split(), "cc": "ção ão lh nh é qu".split()}


def words_of(lang, n, r):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))


def language_rows():
    r = random.Random(21)
    rows = []
    for i in range(240):
        lang = r.choice(list(SYLLABLES))
        rows.append((i, "s", lang, 1, words_of(lang, r.randint(3, 60), r)))
    return rows


def test_languages_of_held_out_rows(spark):
    rows = language_rows()
    more = [(300, "s", None, 1, words_of("bb", 30, random.Random(1))), (301, "s", "aa", 1, None), (302, "s", "aa", 1, ""), (303, "s", "aa", 1, "12 34 !! 😀"),
            (None, "s", "bb", 1, words_of("cc", 30, random.Random(2))), (5, "s", "aa", 1, words_of("bb", 30, random.Random(3))),
            (305, "s", None, 1, (words_of("cc", 50, random.Random(4)) + " ") * 2000), *[(306, "s", "cc", 1, rows[0][4].upper())] * 3]
    got = langid.languages(frame(spark, rows + more)).collect()
    assert len(got) == len(rows) + len(more)
    by = defaultdict(list)
    for x in got:
        by[x.doc_id].append(x)
    held = [(x, r) for r in rows if r[0] != 5 for x in by[r[0]] if x.held_out]
    assert {x.doc_id for x, _ in held} == {r[0] for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2 and r[0] != 5}
    assert sum(x.lang_pred == r[2] for x, r in held) >= 0.97 * len(held)
    assert [by[i][0].lang_pred for i in (300, 301, 302, 303, None, 305)] == ["bb", "und", "und", "und", "cc", "cc"]
    assert all(x.score == 0 and x.rejected for i in (301, 302, 303) for x in by[i])
    assert {x.lang_pred for x in by[306]} == {rows[0][2]} and not by[None][0].held_out
    assert all(0 <= x.score <= 1 for x in got)


def test_held_out_labels_and_other_columns_change_nothing(spark):
    rows = language_rows()
    changed = [(i, "other" + str(i), "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang, 99, t) for i, _, lang, _, t in rows]
    one, other = (sorted(tuple(x) for x in langid.languages(frame(spark, x)).collect()) for x in (rows, changed))
    assert one == other


def test_scores_do_not_depend_on_pieces(spark, monkeypatch):
    rows = language_rows()[:60]
    whole = [sorted(langid.subwords(np.frombuffer(f" {t} ".encode(), np.uint8))[0].tolist()) for *_, t in rows]
    monkeypatch.setattr(langid, "CHUNK", 7)
    cut = [sorted(b for _, piece in langid.chunks(np.frombuffer(f" {t} ".encode(), np.uint8)) for b, at in zip(*langid.subwords(piece), strict=True) if at < 7)
           for *_, t in rows]
    assert whole == cut


def test_languages_without_labels_and_of_an_empty_table(spark):
    rows = [(1, "s", None, 1, "some text"), (2, "s", None, 1, None)]
    got = langid.languages(frame(spark, rows)).collect()
    assert [(x.lang_pred, x.score, x.rejected) for x in got] == [("und", 0.0, True)] * 2
    assert langid.languages(frame(spark, rows).filter("false")).collect() == []
    one = langid.languages(frame(spark, [(i, "s", "en", 1, f"word{'s' * i}") for i in range(9)])).collect()
    assert {(x.lang_pred, x.score) for x in one} == {("en", 1.0)}


def test_rejection_level_is_the_share_asked_for():
    r = np.random.default_rng(0)
    y = r.integers(0, 3, 2000)
    z = r.normal(0, 1, (2000, 3))
    z[np.arange(2000), y] += 4
    t, level = langid.calibrate(z, y, 0.05)
    own = langid.softmax(z / t)[np.arange(2000), y]
    assert 0.045 <= (own < level).mean() <= 0.05 and 0.22 < t < 0.32  # the true log odds are four times z
