"""Per-document operators and their digests, against plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tabulon.llm import language, licences, line_dedup, mixing, packing, quality, simhash, suffixes, token_counts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE = packing.tokenizer_file("word_bpe_49k.json")
PIECES = packing.tokenizer_file("piece_bpe_32k.model")
RUNS = {
    "mix": mixing.mix, "language": language.identify, "tokens": lambda d: token_counts.count_tokens(d, PIECES), "pack": lambda d: packing.pack(d, BPE),
    "simhash": lambda d: simhash.digest(simhash.near_duplicates(d)), "quality": quality.quality_report, "suffixes": lambda d: suffixes.digest(suffixes.remove_repeats(d)),
    "licences": licences.scan, "lines": line_dedup.duplicate_lines,
}


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("name", RUNS)
def test_clashing_columns_change_nothing(name, odd, clashing):
    assert plain(RUNS[name](clashing(odd))) == plain(RUNS[name](odd))


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(name, docs_of):
    assert RUNS[name](docs_of([])).collect() == []


@pytest.mark.parametrize("name", [n for n in RUNS if n not in ("pack", "lines")])
def test_one_row_per_row(name, odd):
    got = Counter(r["doc_id"] for r in RUNS[name](odd).collect())
    assert got == Counter(r["doc_id"] for r in odd.collect())


@pytest.mark.parametrize("keep", [quality.keep_good, line_dedup.drop_duplicate_lines, simhash.keep_one, mixing.repeat_rows])
def test_stages_keep_columns(keep, odd, docs_of, clashing):
    for df in (odd, clashing(odd), docs_of([])):
        assert keep(df).schema.names == df.schema.names
        keep(df).collect()


def test_quality_counts(odd):
    got = {(r["doc_id"], r["n_words"]): r for r in quality.quality_report(odd).collect()}
    for row in odd.collect():
        text = row["text"] or ""
        words = WORD.findall(text)
        grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        marked = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[(row["doc_id"], len(words))]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(marked) > 20 * len(words))
        assert not (r["base_failed"] and r["kept"])


def test_quality_thresholds_follow_the_group(docs_of, prose):
    good = [(i, prose(i, 80), "en", "a", 0) for i in range(40)]
    # in source "code" symbols are usual, in "a" they are not
    code = [(100 + i, " ".join(w + "##" for w in prose(100 + i, 80).split()), "en", "code", 0) for i in range(40)]
    junk = [(200, code[0][1], "en", "a", 0), (201, prose(201, 80).upper(), "en", "a", 0), (202, " ".join(w + " " + w for w in prose(202, 60).split()), "en", "a", 0)]
    kept = {r["doc_id"] for r in quality.quality_report(docs_of(good + code + junk)).filter("kept").collect()}
    assert kept == {r[0] for r in good + code}


def test_simhash_against_brute_force(docs_of, prose):
    base = prose(7, 200).split(" ")
    texts = [(i, " ".join(base[:i % 40] + ["x"] * (i % 3) + base[i % 40:])) for i in range(120)] + [(500, None), (501, ""), (502, "Two Words"), (503, "two  words"), (504, prose(9, 30))]
    got = {r["doc_id"]: r for r in simhash.digest(simhash.near_duplicates(docs_of(texts))).collect()}
    prints = {}
    for i, t in texts:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        shingles = [" ".join(w[k:k + 3]) for k in range(len(w) - 2)] or [" ".join(w)] * bool(w)
        hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
        prints[i] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
        assert got[i]["fingerprint"] == f"{prints[i]:016x}"
    assert {i: r["component_id"] for i, r in got.items()} == smallest(prints, lambda a, b: (a ^ b).bit_count() <= 3)


def smallest(nodes, linked):
    """Smallest key reachable over links, for few nodes."""
    parent = {k: k for k in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    keys = sorted(nodes)
    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if linked(nodes[a], nodes[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: find(k) for k in nodes}


@pytest.mark.parametrize("block", [4096, 3])
def test_simhash_links_in_any_block_size(spark, block):
    r = np.random.default_rng(3)
    seeds = r.integers(-2 ** 63, 2 ** 63, 12)
    prints = {int(s) for s in seeds} | {int(s ^ np.bitwise_or.reduce(np.int64(1) << r.integers(0, 63, k))) for s in seeds for k in (1, 2, 3, 4, 5) for _ in range(6)}
    links = simhash.hamming_links(spark.createDataFrame([(p,) for p in prints], "fp long"), block).collect()
    mask = 2 ** 64 - 1
    want = smallest({p: p for p in prints}, lambda a, b: ((a ^ b) & mask).bit_count() <= 3)
    pairs = {(x["a"], x["b"]) for x in links}
    assert smallest({p: p for p in prints}, lambda a, b: (a, b) in pairs or (b, a) in pairs) == want


def test_mixing_targets_and_budgets(docs_of, prose):
    rows = [(100 * s + i, prose(100 * s + i, 20 + 13 * i % 90), "en", src, 0) for s, (src, n) in enumerate([("b", 40), ("a", 30), (None, 25), ("c", 3), ("é", 35)]) for i in range(n)]
    got = mixing.mix(docs_of(rows)).collect()
    size = {r[0]: len(WORD.findall(r[1])) for r in rows}
    assert all(r["size"] == size[r["doc_id"]] for r in got)
    per = {s: sum(size[r[0]] for r in rows if r[3] == s) for s in ("a", "b", "c", "é", None)}
    weight = dict(zip(("a", "b", "c", "é", None), (5, 2, 1, 5, 2)))
    total, capped = sum(per.values()), set()
    while True:
        left = total - sum(3 * per[s] for s in capped)
        target = {s: 3 * per[s] if s in capped else left * weight[s] / sum(w for x, w in weight.items() if x not in capped) for s in per}
        over = {s for s in per if s not in capped and target[s] > 3 * per[s]}
        if not over:
            break
        capped |= over
    for s in per:
        mine = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in mine} == {per[s]} and abs(mine[0]["target"] - target[s]) < 1e-6
        assert abs(sum(r["taken"] for r in mine) - target[s]) <= max(3, 0.03 * target[s])
        assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * (r["epochs"] + r["extra"]) for r in mine)
    assert plain(mixing.digest(mixing.mix(docs_of(rows[::-1]).repartition(5)))) == plain(mixing.digest(mixing.mix(docs_of(rows))))


def test_mixing_against_brute_force(docs_of, prose):
    import hashlib
    import math
    rows = [(50 * s + i, prose(50 * s + i, 5 + 17 * i % 120), "en", src, 0) for s, (src, n) in enumerate([("a", 40), ("b", 30), ("c", 45), (None, 20)]) for i in range(n)]
    got = mixing.mix(docs_of(rows)).collect()
    for source in ("a", "b", "c", None):
        mine = {r["doc_id"]: r for r in got if r["source"] == source}
        first = next(iter(mine.values()))
        budget = math.floor(first["target"] - first["epochs"] * first["source_size"] + 0.5)
        order = []
        for i, text, _, src, _ in rows:
            if src == source:
                u = (int(hashlib.md5(f"mix:{i}".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
                share = max(0.05, sum(c.isascii() and c.isalpha() or not c.isascii() for c in text) / len(text))
                order.append((-math.log(u) / share, i, mine[i]["size"]))
        order.sort()
        extra, total = set(), 0
        most = budget
        while True:  # the order until one does not fit, best fits, and on past what is too long
            for _, i, n in order:
                if i in extra or n == 0 or n > most:
                    continue
                if total + n > budget:
                    break
                extra.add(i)
                total += n
            for _ in range(mixing.FILLS - 1):
                gap = budget - total
                free = [(gap - n, key, i, n) for key, i, n in order if i not in extra and 0 < n <= gap]
                if free:
                    extra.add(min(free)[2])
                    total += min(free)[3]
            most = budget - total
            if not any(i not in extra and 0 < n <= most for _, i, n in order):
                break
        gap = budget - total
        free = [(abs(gap - n), key, i, n) for key, i, n in order if i not in extra and n > 0 and abs(gap - n) < gap]
        if free:
            extra.add(min(free)[2])
        assert {i for i, r in mine.items() if r["extra"] and r["size"]} == {i for i in extra if mine[i]["size"]}


@pytest.mark.parametrize("row_id", [9999, None])
@pytest.mark.parametrize("share", [16.0, 14.0, 25.0])
def test_mixing_takes_repeated_rows_one_by_one(docs_of, row_id, share):
    rows = [(i, "word " * 20, "en", "a", 0) for i in range(300)] + [(row_id, "copy " * 50, "en", "a", 0)] * 400
    rows += [(20_000 + i, "other " * 20, "en", "b", 0) for i in range(700)]
    df = docs_of(rows).repartition(7)
    got = mixing.mix(df, weights=(share, 40 - share), most=50).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((r[0], len(r[1].split())) for r in rows)
    for source in "ab":
        mine = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 50
    again = mixing.repeat_rows(df, weights=(share, 40 - share), most=50)
    want = Counter()
    for r in got:
        want[(r["doc_id"], r["source"])] += r["epochs"] + r["extra"]
    assert Counter((r["doc_id"], r["source"]) for r in again.collect()) == +want


def test_mixing_rows_of_one_id_and_size_with_different_texts(docs_of):
    rows = [(1, "aa bb 11 22", "en", "a", 0), (1, "aa bb cc dd", "en", "a", 0)] * 50 + [(i, "x y", "en", "a" if i % 3 else "b", 0) for i in range(10, 300)]
    got = mixing.mix(docs_of(rows)).collect()
    again = mixing.repeat_rows(docs_of(rows)).collect()
    assert len(got) == len(rows) and sum(r["taken"] for r in got) == sum(len(r["text"].split()) for r in again)


def test_mixing_prefers_heavy_documents(spark, docs_of):
    df = docs_of([(i, "a b c d", "en", "x" if i < 400 else "y", 0) for i in range(800)])
    heavy = F.when(F.col("doc_id") % 2 == 0, 9.0).otherwise(1.0)
    taken = [r["doc_id"] for r in mixing.mix(df, heavy).filter("source = 'y' AND extra").collect()]
    assert sum(i % 2 == 0 for i in taken) > 0.75 * len(taken) > 50


def test_mixing_goes_on_after_a_very_long_document(docs_of, prose):
    rows = [(1000 * s + i, "word " * 20 if i else "long " * 10_000, "en", src, 0) for s, src in enumerate("ab") for i in range(600)]
    first = F.when(F.col("doc_id") % 1000 == 0, 1e9).otherwise(1.0)  # the long one leads the order; in a it does not fit
    got = mixing.mix(docs_of(rows), first, weights=(7.0, 3.0)).collect()
    for source in "ab":
        mine = [r for r in got if r["source"] == source]
        assert source == "b" or 0 < mine[0]["target"] % mine[0]["source_size"] < 10_000
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= 20


def test_language_learns_and_marks_unknown(docs_of, prose):
    other = str.maketrans("taeiorn", "zöxquvj")
    rows = [(i, prose(i, 30) if i % 2 else prose(i, 30).translate(other), "aa" if i % 2 else "bb", "s", 0) for i in range(200)]
    rows += [(1000, None, "aa", "s", 0), (1001, "12 34 --", "aa", "s", 0), (1002, "", None, "s", 0)]
    got = {r["doc_id"]: r for r in language.identify(docs_of(rows)).collect()}
    for i, _, lang, *_ in rows[:200]:
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1000, 1001, 1002))


def test_language_kernel_is_the_shared_presence():
    def grams(t):
        t = " " + t + " "
        return {(n, t[i:i + n]) for n in language.ORDERS for i in range(len(t) - n + 1)}
    a, b = "some words here", "other words there"
    flags = [np.zeros(language.WIDTH, bool) for _ in range(2)]
    for t, f in zip((a, b), flags):
        assert language.presence(t, f)
    assert [int(f.sum()) for f in flags] == [len(grams(a)), len(grams(b))]
    assert int((flags[0] & flags[1]).sum()) == len(grams(a) & grams(b))
    whole, parts = np.zeros(language.WIDTH, bool), np.zeros(language.WIDTH, bool)
    text = "ab cd. " * 40
    language.presence(text, whole)
    span, language.SPAN = language.SPAN, 7
    try:
        language.presence(text, parts)
    finally:
        language.SPAN = span
    assert (whole == parts).all()


def test_language_without_labels(docs_of):
    got = language.identify(docs_of([(1, "words", None, "s", 0), (2, "more words", None, "s", 0)])).collect()
    assert {(r["lang_pred"], r["score"]) for r in got} == {("und", 0.0)}


def test_token_counts_against_one_by_one(odd):
    scores = token_counts.piece_scores(PIECES)
    longest = max(map(len, scores))
    got = Counter((r["doc_id"], r["n_words"], r["n_tokens"]) for r in token_counts.count_tokens(odd, PIECES).collect())
    memo = {}
    want = Counter()
    for r in odd.collect():
        words = WORD.findall(r["text"] or "")
        for w in words:
            memo.setdefault(w, token_counts.segment(token_counts.MARK + w, scores, longest))
        want[(r["doc_id"], len(words), sum(memo[w] for w in words))] += 1
    assert got == want


def test_packing_round_trip(odd):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(BPE)
    want = Counter()
    for r in odd.collect():
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1], "<u4")
        for p, at in enumerate(range(0, len(ids), 4096)):
            want[(r["doc_id"], p, at, len(ids[at:at + 4096]), zlib.crc32(ids[at:at + 4096].tobytes()))] += 1
    rows = packing.pack(odd, BPE).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    filled = Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled[r["sequence_id"]] == r["offset"]
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 4096


@pytest.mark.parametrize("seed", range(6))
def test_bin_completion(seed):
    r = np.random.default_rng(seed)
    counts = np.bincount(r.integers(8, 70, 40), minlength=101)
    first, best = packing.best_fit_decreasing(counts, 100), packing.complete_bins(counts, 100, 500)
    for plan in (first, best):
        used = Counter()
        for pattern, times in plan:
            assert sum(pattern) <= 100
            for x in pattern:
                used[x] += times
        assert used == {i: c for i, c in enumerate(counts.tolist()) if c}
    assert -(-int((counts * np.arange(101)).sum()) // 100) <= sum(n for _, n in best) <= sum(n for _, n in first)


def test_bin_completion_beats_best_fit():
    counts = np.zeros(11, int)
    counts[[3, 4, 5, 6]] = [2, 1, 2, 1]  # 6+4, 5+5, 3+3 ...
    assert sum(n for _, n in packing.complete_bins(counts, 10)) == 3


def test_bin_completion_of_all_lengths():
    counts = 1 + np.bincount(np.clip(np.random.default_rng(0).lognormal(7.2, 0.5, 1_000_000).astype(int), 1, 4095), minlength=4097)
    counts[[0, 4096]] = 0
    first, best = packing.best_fit_decreasing(counts, 4096), packing.complete_bins(counts)
    used = Counter()
    for pattern, times in best:
        assert sum(pattern) <= 4096
        for x in pattern:
            used[x] += times
    assert used == {i: c for i, c in enumerate(counts.tolist()) if c}
    assert sum(n for _, n in best) < sum(n for _, n in first)


def test_suffix_order():
    r = np.random.default_rng(1)
    for n in (1, 2, 40, 500):
        t = r.integers(0, 3, n).astype(np.uint8)
        t[-1] = 0
        raw = t.tobytes()
        keys = [raw[i:i + 56].ljust(56, b"\0") for i in suffixes.sort_suffixes(t)]
        assert keys == sorted(keys) and len(keys) == n


def test_suffixes_with_long_ties_are_sorted_by_one_key_a_round(monkeypatch):
    rng = np.random.default_rng(8)
    passage = bytes(rng.integers(97, 100, 300).astype(np.uint8))
    parts = [passage[i:i + n] for i, n in zip(rng.integers(0, 200, 400).tolist(), rng.integers(1, 100, 400).tolist())]
    text = np.frombuffer(b"\0" + b"\0".join(parts) + b"\0" + b"b" * 200 + bytes([255]) * 70 + b"\0", np.uint8)
    monkeypatch.setattr(np, "lexsort", None)  # a sort of all 56 bytes at every place took most of a block's time
    raw = text.tobytes()
    order = suffixes.sort_suffixes(text)
    keys = [raw[i:i + 56].ljust(56, b"\0") for i in order.tolist()]
    assert keys == sorted(keys) and sorted(order.tolist()) == list(range(len(text)))


@pytest.mark.parametrize("heavy", [20_000, 2])
def test_repeats_against_brute_force(docs_of, prose, monkeypatch, heavy):
    import hashlib
    monkeypatch.setattr(suffixes, "HEAVY", heavy)
    shared, tight = prose(50, 30), "q" * 49
    texts = [(i, prose(i, 20) + (shared[i:] if i % 3 else "") + prose(1000 + i, 15)) for i in range(30)]
    texts += [(40, texts[5][1]), (41, texts[5][1]), (42, tight), (43, tight), (44, tight + "q"), (45, "x" + tight + "q" * 9), (46, None), (47, "é" * 60), (48, "a" + "é" * 60)]
    got = {tuple(r) for r in suffixes.digest(suffixes.remove_repeats(docs_of(texts))).collect()}
    first, want = {}, set()
    for i, t in sorted(texts):
        raw = (t or "").encode()
        cut = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - 49):
            if first.setdefault(raw[at:at + 50], i) < i:
                cut[at:at + 50] = True
        left = bytes(c for c, x in zip(raw, cut) if not x)
        want.add((i, len(raw), len(raw) - len(left), int((np.diff(cut.astype(int), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest()))
    assert got == want


def test_licences(docs_of):
    mit = "\n".join(["Copyright (c) 2020 A. Person", "", licences.SENTENCES["mit.grant"].replace("Software, and to", "Software,\nand to") + ":", "", licences.SENTENCES["mit.keep"] + ".", "",
                     licences.SENTENCES["mit.asis"].replace("KIND, ", "KIND,\n# ") + ". " + licences.SENTENCES["mit.liability"] + "."])
    rows = [(1, "Intro\nReleased under the MIT License.\nMore."), (2, mit), (3, "\n".join(mit.split("\n")[::-1])), (4, "A license to fish."), (5, None),
            (6, "Licensed under CC BY-NC 4.0. This work is licensed under the GNU General Public License, version 3."), (7, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0!"),
            (8, "\n\n".join(licences.SENTENCES[x] + "." for x in ("bsd.grant", "bsd.source", "bsd.binary", "bsd.names", "bsd.asis")))]
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs_of(rows)).collect()}
    assert got == {1: "MIT", 2: "MIT", 3: "", 4: "", 5: "", 6: "CC-BY-NC-4.0,GPL-3.0", 7: "Apache-2.0", 8: "BSD-3-Clause"}


def test_licences_with_holders_and_headers(docs_of):
    def bsd(clause):
        parts = [licences.SENTENCES[x] + "." for x in ("bsd.grant", "bsd.source", "bsd.binary")] + [clause] * bool(clause) + [licences.SENTENCES["bsd.asis"] + "."]
        return "\n\n".join(parts)

    tail = "contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    def gnu(what, which, either, see):
        return (f"This {what} is free software: you can redistribute it and/or modify\nit under the terms of the GNU {which} General Public License as published by\nthe Free Software Foundation{either} of the License, or\n(at your option) any later version.\n\n"
                f"This {what} is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU {see} General Public License for more details.").replace("GNU  ", "GNU ")
    rows = [(1, bsd("    * Neither the name of Google Inc. nor the names of its\n " + tail)), (2, bsd("")), (3, bsd("3. Neither the name of the <organization> nor the\n   names of its\n" + tail)),
            (4, bsd("The name of the author may not be used to endorse or promote products derived from this software.")), (5, bsd("Neither the name of the copyright holder nor the names of its " + tail)),
            (6, gnu("program", "Affero", ", either version 3", "Affero")), (7, gnu("library", "Lesser", "; either version 2.1", "Lesser")), (8, gnu("program", "Lesser", ", either version 3", "Lesser")),
            (9, gnu("library", "Library", "; either version 2", "Library")), (10, gnu("program", "", "; either version 3", "")), (11, gnu("program", "", "; either version 2", ""))]
    got = {r["doc_id"]: r["licences"] for r in licences.scan(docs_of(rows)).collect()}
    assert got == {1: "BSD-3-Clause", 2: "BSD-2-Clause", 3: "BSD-3-Clause", 4: "", 5: "BSD-3-Clause", 6: "AGPL-3.0-or-later", 7: "LGPL-2.1-or-later", 8: "LGPL-3.0-or-later",
                   9: "LGPL-2.0-or-later", 10: "GPL-3.0-or-later", 11: "GPL-2.0-or-later"}


@pytest.mark.parametrize("block", [1024, 2])
def test_lines_against_brute_force(docs_of, prose, block):
    base = prose(5, 24, 24)
    texts = [(i, "\n".join([prose(i, 24, 24), base.replace(" ", " x" if i % 4 == 0 else " ", 1), base[i:], "", "short", "é" * (i % 3 + 5)])) for i in range(20)] + [(30, None), (31, "\n \n")]
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.duplicate_lines(docs_of(texts), block).collect()}
    lines = {(i, n): x for i, t in texts for n, x in enumerate((t or "").split("\n")) if WORD.search(x)}
    sets = {k: frozenset([x]) if len(x) < line_dedup.WHOLE else frozenset(x[j:j + 4] for j in range(len(x) - 3)) for k, x in lines.items()}
    assert line_dedup.SHINGLE == 4 and got == smallest(sets, lambda a, b: len(a & b) >= 0.8 * len(a | b))


def test_sketches_keep_pairs_at_the_threshold(prose):
    r = np.random.default_rng(8)
    lines = []
    for n in (30, 60, 90, 200, 900):
        for _ in range(150):
            x = list("".join(r.choice(list("abcdefghijklmnop   "), n)))
            lines.append("".join(x))
            for k in r.integers(0, n, max(1, n // 36)):
                x[k] = "#"
            lines.append("".join(x))
    a = np.arange(0, len(lines), 2)
    near = line_dedup._similar_pairs(lines, a, a + 1)
    sets = [frozenset(x[j:j + 4] for j in range(len(x) - 3)) for x in lines]
    assert near.tolist() == [len(sets[i] & sets[i + 1]) >= 0.8 * len(sets[i] | sets[i + 1]) for i in a] and 100 < near.sum() < 700
    sketches = line_dedup.sketch_words(line_dedup.signatures(lines)[1])
    assert line_dedup.alike(sketches, a, a + 1)[near].all()
    others = r.permutation(len(lines) // 2) * 2
    assert line_dedup.alike(sketches, a[300:], others[300:])[a[300:] != others[300:]].mean() < 0.05


@pytest.mark.parametrize("small, step", [(48, 4096), (3, 10), (1, 5)])
def test_parties_and_links_at_any_step(docs_of, prose, monkeypatch, small, step):
    import pyarrow as pa
    monkeypatch.setattr(line_dedup, "SMALL", small)
    monkeypatch.setattr(line_dedup, "STEP", step)
    lines = [prose(i % 12, 24, 24) + "abcdefgh"[:i // 12] for i in range(60)]
    meet = [i // 20 for i in range(60)]
    sketches = [x.tobytes() for x in line_dedup.signatures(lines)[1]]
    batches = [pa.record_batch({"meet": pa.array(meet[i:i + 7], pa.int64()), "id": pa.array(range(i, min(i + 7, 60)), pa.int64()), "x": pa.array(sketches[i:i + 7], pa.binary())}) for i in range(0, 60, 7)]
    parties = {}
    for b in line_dedup._parties(iter(batches)):
        for p, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            parties.setdefault(p, set()).add(i)
    assert sorted(map(sorted, parties.values())) == sorted([i for i in range(g, g + 20) if i % 12 == k] for g in (0, 20, 40) for k in range(12) if len([i for i in range(g, g + 20) if i % 12 == k]) > 1)
    rows = sorted((p, i) for p, m in parties.items() for i in m)
    batches = [pa.record_batch({"party": pa.array([p for p, _ in rows[k:k + 7]], pa.int64()), "id": pa.array([i for _, i in rows[k:k + 7]], pa.int64()), "text": [lines[i] for _, i in rows[k:k + 7]]}) for k in range(0, len(rows), 7)]
    links = {(x, y) for b in line_dedup._verify(iter(batches)) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert links == {(i, min(m)) for m in parties.values() for i in m if i != min(m)}


@pytest.mark.parametrize("block, size", [(100, 7), (100, 1000), (10, 7), (10, 1000)])
def test_only_alike_members_leave_a_bucket_but_crowded_ones_whole(prose, block, size):
    import pyarrow as pa
    lines = [prose(100 + i, 24) for i in range(30)] + [prose(7, 24) + "abc"[:i] for i in range(3)] + [prose(8, 24), prose(8, 24) + "x", prose(9, 24)]
    key = [5] * 33 + [6] * 2 + [7]
    sketches = [x.tobytes() for x in line_dedup.signatures(lines)[1]]
    batches = [pa.record_batch({"key": pa.array(key[i:i + size], pa.int64()), "id": pa.array(range(i, min(i + size, 36)), pa.int64()), "sketch": pa.array(sketches[i:i + size], pa.binary())}) for i in range(0, 36, size)]
    rows = [r for b in line_dedup._meet(block)(iter(batches)) for r in b.to_pylist()]
    parties = {}
    for r in rows:
        if r["sketch"] is None:
            parties.setdefault(r["party"], set()).add(r["id"])
    assert sorted(map(sorted, parties.values())) == ([[30, 31, 32]] if block == 100 else []) + [[33, 34]]
    assert sorted((r["party"], r["id"], r["sketch"]) for r in rows if r["sketch"]) == ([] if block == 100 else [(5, i, sketches[i]) for i in range(33)])


@pytest.mark.parametrize("held, block, slots", [(1 << 20, 100, 3), (40, 100, 3), (40, 10, 2), (5, 3, 70_000)])
def test_buckets_that_travel_in_slots_meet_as_sorted_rows_do(prose, monkeypatch, held, block, slots):
    import pyarrow as pa
    monkeypatch.setattr(line_dedup, "HELD", held)
    lines = [prose(7, 24) + "abcdefghijklmnop"[:i % 16] + "x" * (i // 16) for i in range(60)] + [prose(100 + i, 24) for i in range(60)] + [prose(100 + i, 24) + "y" for i in range(20)]
    keys, sketches = line_dedup.signatures(lines)
    bands = [keys[i].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :line_dedup.KEY_BYTES].tobytes() + sketches[i].tobytes() for i in range(140)]
    dealt = [r for i in range(0, 140, 30) for r in line_dedup._deal_bands(slots)(iter([pa.record_batch({"id": pa.array(range(i, min(i + 30, 140)), pa.int64()), "bands": pa.array(bands[i:i + 30], pa.binary())})]))]
    dealt = pa.Table.from_batches(dealt).sort_by("slot")
    raw = [(int.from_bytes(b[j * 5:j * 5 + 5], "little") << 8 | j, i, b[-line_dedup._SKETCH:]) for i, b in enumerate(bands) for j in range(line_dedup.BANDS)]
    rows = pa.table({"key": pa.array([r[0] for r in raw], pa.int64()), "id": pa.array([r[1] for r in raw], pa.int64()), "sketch": pa.array([r[2] for r in raw], pa.binary())}).sort_by("key")
    took = lambda batches: Counter(tuple(r.values()) for b in batches for r in b.to_pylist())
    got = took(line_dedup._meet_in_slots(block)(iter(dealt.to_batches(7))))
    assert got == took(line_dedup._meet(block)(iter(rows.to_batches()))) and len(got) > 100 and any(r[2] for r in got) == (block < 100)


def test_only_pairs_that_may_reach_the_threshold_are_compared(prose, monkeypatch):
    r = np.random.default_rng(4)
    lines = []
    for i in range(12):
        base = prose(i, 60, 60)
        for k in (0, 4, 40, 50, 60):
            x = list(base)
            for j in r.choice(len(x), k, replace=False):
                x[j] = "#"
            lines.append("".join(x))
    sets = [frozenset(x[j:j + 4] for j in range(len(x) - 3)) for x in lines]
    a, b = np.triu_indices(60, 1)
    near = np.array([len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i, j in zip(a, b)])
    hashed = line_dedup._shingle_sets(lines)
    maybe = line_dedup._maybe_similar(line_dedup._maps(hashed), np.diff(hashed[1]), a, b)
    assert maybe[near].all() and near.sum() >= 12 and maybe.sum() < 2 * near.sum() + 12
    asked, compare = [], line_dedup._similar_sets
    monkeypatch.setattr(line_dedup, "_similar_sets", lambda sets, a, b: asked.extend(a) or compare(sets, a, b))
    want = line_dedup.roots(a[near], b[near], 60)
    sketches = line_dedup.sketch_words(line_dedup.signatures(lines)[1])
    for known in (None, np.arange(60), want):
        for small in (48, 3):
            monkeypatch.setattr(line_dedup, "SMALL", small)
            asked.clear()
            assert line_dedup._joined(lines, np.array([0]), sketches, known).tolist() == want.tolist()
            assert len(asked) <= (0 if known is want else maybe.sum())


def test_what_one_party_has_settled_does_not_meet_again(prose):
    import pyarrow as pa
    base, other = prose(1, 60, 60), prose(2, 60, 60)
    lines = [base, base + "a", base + "bc", other, other + "a", other + "bc"]
    sketches = [x.tobytes() for x in line_dedup.signatures(lines)[1]]
    def left(ids, joined, met):
        rows = pa.record_batch({"party": pa.array([9] * len(ids), pa.int64()), "id": pa.array(ids, pa.int64()), "sketch": pa.array([sketches[i] for i in ids], pa.binary()), "joined": pa.array(joined, pa.int64()), "met": met})
        return sorted((r["id"], r["joined"]) for b in line_dedup._left_open(iter([rows])) for r in b.to_pylist())
    assert left([0, 1, 2], [0, 0, 0], [True, True, False]) == []
    assert left([0, 1, 2], [0, 1, 2], [True, True, True]) == []
    assert left([0, 1, 2, 3], [0, 0, 2, 3], [True, True, False, False]) == [(0, 0), (1, 0), (2, 2)]
    assert left([0, 2, 3, 4, 5], [0, 0, 3, 3, 5], [False, False, True, True, True]) == []


@pytest.mark.parametrize("small, few, pivots", [(48, 64, 4), (3, 64, 1), (3, 0, 1)])
def test_joined_members_are_not_compared_again(prose, monkeypatch, small, few, pivots):
    for name, value in (("SMALL", small), ("FEW", few), ("PIVOTS", pivots)):
        monkeypatch.setattr(line_dedup, name, value)
    asked, compare = [], line_dedup._similar_sets
    monkeypatch.setattr(line_dedup, "_similar_sets", lambda sets, a, b: asked.extend(a) or compare(sets, a, b))
    copies = [prose(3, 40) + "abcdefghijklmnopqrstuvwxyz"[:i % 26] + str(i) for i in range(40)]
    assert line_dedup._joined(copies, np.array([0])).tolist() == [0] * 40 and len(asked) == 39
    r = np.random.default_rng(6)
    lines = []
    for i in range(90):
        x = prose(i % 5, 30).split(" ")
        for k in r.integers(0, len(x), 4):
            x[k] = f"w{r.integers(9)}"
        lines.append(" ".join(x))
    lines[40] = "short"
    starts = np.array([0, 1, 30, 34])
    sets = [frozenset([x]) if len(x) < 8 else frozenset(x[j:j + 4] for j in range(len(x) - 3)) for x in lines]
    group = np.searchsorted(starts, np.arange(90), "right")
    near = [(i, j) for i in range(90) for j in range(i) if group[i] == group[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    want = line_dedup.roots(np.array([i for i, _ in near]), np.array([j for _, j in near]), 90)
    assert line_dedup._joined(lines, starts).tolist() == want.tolist() and len(set(want.tolist())) > 12


def test_one_changed_character_links_short_lines(docs_of):
    r = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    lines = ["x" + "".join(r.choice(letters, n - 2)) + "x" for n in range(40, 71)]
    edited = [x[:len(x) // 2] + "7" + x[len(x) // 2 + 1:] for x in lines]
    got = {(r["doc_id"], r["line_no"]): (r["keep_doc_id"], r["keep_line_no"]) for r in line_dedup.duplicate_lines(docs_of([(1, "\n".join(lines)), (2, "\n".join(edited))])).collect()}
    assert got == {(d, i): (1, i) for d in (1, 2) for i in range(len(lines))}


def test_dropping_lines(docs_of, prose):
    a, b = prose(1, 24).split("\n"), prose(2, 24).split("\n")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.drop_duplicate_lines(docs_of([(1, "\n".join(a)), (2, "\n".join([b[0], a[1]])), (3, a[0]), (4, "")])).collect()}
    assert got == {1: ("\n".join(a), len("\n".join(a))), 2: (b[0], len(b[0])), 4: ("", 0)}


def test_keep_one(docs_of, prose):
    rows = [(5, prose(1, 50)), (3, prose(1, 50)), (3, prose(1, 50)), (7, prose(2, 50)), (None, prose(3, 50)), (None, prose(3, 50)), (None, prose(2, 50))]
    assert Counter(r["doc_id"] for r in simhash.keep_one(docs_of(rows)).collect()) == {3: 1, 7: 1, None: 1}


def test_keep_one_of_each_component_of_a_repeated_id(docs_of, prose):
    a, b, c, d = (prose(i, 50) for i in range(4))
    rows = [(5, a), (5, b), (5, b), (3, c), (5, c), (7, d), (7, a), (None, d), (None, prose(9, 50))]
    got = Counter((r["doc_id"], r["text"]) for r in simhash.keep_one(docs_of(rows)).collect())
    assert got == Counter([(5, a), (5, b), (3, c), (7, d), (None, prose(9, 50))])


def test_lines_of_rows_with_one_id_and_different_texts(docs_of, prose):
    x, y, z, u, v = (prose(i, 24, 24) for i in range(20, 25))
    rows = [(1, x), (2, y + "\n" + z), (2, x + "\n" + u), (None, v), (None, z), (None, v + "\n" + y)]
    got = Counter((r["doc_id"], r["text"]) for r in line_dedup.drop_duplicate_lines(docs_of(rows)).collect())
    assert got == Counter([(1, x), (2, y + "\n" + z), (2, u), (None, v)]) and len(line_dedup.duplicate_lines(docs_of(rows)).collect()) == 9


def test_simhash_cell_crowded_by_visitors(spark):
    own = (1 << 40) - 1  # many fingerprints one step below the cell of one other
    prints = {own} | {own ^ (1 << i) for i in range(40)} | {own ^ (1 << i) ^ (1 << j) for i in range(40) for j in range(i)}
    cells = simhash._cells(spark.createDataFrame([(p,) for p in prints], "fp long"))
    most = simhash._blocks(cells, 50).groupBy("meet").count().agg(F.max("count")).first()[0]
    assert most < 200 < cells.groupBy("half", "cell").count().agg(F.max("count")).first()[0]
    links = simhash.hamming_links(spark.createDataFrame([(p,) for p in prints], "fp long"), 50).collect()
    pairs = {(r["a"], r["b"]) for r in links}
    assert set(smallest({p: p for p in prints}, lambda a, b: (a, b) in pairs or (b, a) in pairs).values()) == {min(prints)}


def test_stored_leaves_no_shuffle_files(spark):
    import os
    import time
    from tabulon.llm import common
    files = lambda: sum(f.startswith("shuffle_") for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for _, _, names in os.walk(d) for f in names)
    before, setting = files(), spark.conf.get(common.CLEANUP)
    back = common.stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().repartition(5), "shuffled")
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and back.count() == 7 and spark.conf.get(common.CLEANUP) == setting
