"""Repeated windows, fill-in-the-middle and token alignment, against plain Python."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tabulon.llm import alignment, middle, packing, recompression

BYTES, PIECES = (packing.tokenizer_file(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
sha = lambda x: hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


RUNS = {"passages": recompression.remove_passages, "middle": middle.fill_in_middle, "align": lambda d: alignment.align(d, BYTES, PIECES)}


@pytest.mark.parametrize("name", RUNS)
def test_clashing_columns_change_nothing(name, odd, clashing):
    assert plain(RUNS[name](clashing(odd))) == plain(RUNS[name](odd))


@pytest.mark.parametrize("name", RUNS)
def test_empty_table(name, docs_of):
    assert RUNS[name](docs_of([])).collect() == []


@pytest.mark.parametrize("name", RUNS)
def test_one_row_per_row(name, odd):
    assert Counter(r["doc_id"] for r in RUNS[name](odd).collect()) == Counter(r["doc_id"] for r in odd.collect())


# ---- repeated windows

def without_repeats(rows, window=20):
    """Rows (doc_id, text): windows seen before, in the order of doc_id, go."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows)):
        words = text.encode().split()
        gone, own = set(), set()
        for i in range(len(words) - window + 1):
            w = tuple(words[i:i + window])
            if w in seen or w in own:
                gone.update(range(i, i + window))
            own.add(w)
        seen |= own
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[doc_id, text] = (doc_id, len(words), len(gone), sha(kept))
    return [out[r] for r in rows]


def passages(prose):
    shared = [prose(500 + i, 21 + 13 * i).split() for i in range(8)]
    rows = []
    for i in range(80):
        words = prose(i, 150).split()
        for k in range(i % 4):
            at = (37 * i + 61 * k) % len(words)
            words[at:at] = shared[(i + 3 * k) % 8][(i % 3):]
        rows.append((1000 - i, " ".join(words) if i % 2 else "\n".join(words)))
    rows += [(i, rows[i][1]) for i in range(0, 40, 7)]  # equal texts
    rows += [(2000 + i, " ".join(rows[5][1].split()[:-i])) for i in range(1, 30, 3)]  # near copies
    rows += [(3000, "a " * 100), (3001, "a " * 19), (3002, "a " * 20 + "b"), (3003, "a b " * 40), (3004, "b " + "a b " * 30), (3005, "x" * 5000), (3006, ""), (3007, "a " * 100)]
    rows += [(3010, prose(600, 70) + " " + prose(600, 70)), (3011, prose(601, 19) + " " + prose(600, 70)), (3012, prose(600, 30)), (3013, prose(602, 10))]
    return rows


def test_passages_against_brute_force(docs_of, prose):
    rows = passages(prose)
    want = sorted(without_repeats(rows))
    assert sum(w[2] for w in want) > 2000
    for n in (1, 6):
        assert plain(recompression.digest(recompression.remove_passages(docs_of(rows).repartition(n)))) == sorted(want, key=repr)


def test_passages_of_odd_rows(odd, docs_of, prose):
    text = prose(1, 60)
    rows = [(1, text), (1, text), (None, text), (None, None), (2, text), (3, prose(2, 40) + " " + text)]
    got = sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["n_spans"]) for r in recompression.remove_passages(docs_of(rows)).collect()), key=repr)
    assert got == [(1, 60, 0, 0), (1, 60, 0, 0), (2, 60, 60, 1), (3, 100, 60, 1), (None, 0, 0, 0), (None, 60, 0, 0)]
    one_id = [(7, prose(3, 30) + " " + text), (7, prose(4, 30) + " " + text), (8, text)]
    got = sorted((r["doc_id"], r["n_removed"]) for r in recompression.remove_passages(docs_of(one_id)).collect())
    assert got == [(7, 0), (7, 60), (8, 60)]
    rows = [(r["doc_id"], r["text"] or "") for r in odd.collect() if r["doc_id"] is not None]
    assert plain(recompression.digest(recompression.remove_passages(odd.filter("doc_id IS NOT NULL")))) == sorted(without_repeats(rows), key=repr)


@pytest.mark.parametrize("rounds", [0, 1, 3, 8])
def test_equal_stretches_form_equal_symbols(prose, monkeypatch, rounds):
    import pyarrow as pa
    monkeypatch.setattr(recompression, "ROUNDS", rounds)
    core = prose(9, 40).split()
    texts = [" ".join(prose(10 + i, 5 + i).split() + core + prose(30 + i, 7).split()) for i in range(12)] + [" ".join(core)]
    key, text, first, last = recompression.anchors(recompression.Words(pa.array(texts)))
    bounds = recompression.Words(pa.array(texts)).bounds
    seen = []
    for t in range(len(texts)):
        head = 5 + t if t < 12 else 0
        by = {w - bounds[t] - head: k for k, x, a, b in zip(key, text, first, last) if x == t for w in range(a, b + 1)}
        seen.append([by[i] for i in range(21)])  # the windows inside the core
    assert all(s == seen[0] for s in seen)


# ---- fill in the middle

def by_hand(doc_id, text):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = sha(f"7:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < 50:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_middle_by_hand(odd, docs_of, prose):
    rows = [(i, prose(i, 5 + 7 * i, 4)) for i in range(60)] + [(70, "\n\n\n"), (71, "a\r\nb"), (72, "x <P> y"), (73, "<M>"), (74, "é\n日本\n\x00"), (75, "<P\n><S\n"), (75, "other\ntext")]
    df = docs_of(rows).unionByName(odd)
    want = sorted(((d["doc_id"], *by_hand(d["doc_id"], d["text"] or "")[:4], *(lambda o: (o, sha(o), sha(d["text"] or "")))(by_hand(d["doc_id"], d["text"] or "")[4])) for d in df.collect()), key=repr)
    assert plain(middle.fill_in_middle(df)) == want
    assert {w[2] for w in want} == {"plain", "psm", "spm"}


def test_middle_share_and_seed(docs_of, prose):
    df = docs_of([(i, prose(i, 30, 3)) for i in range(200)])
    forms = Counter(r["form"] for r in middle.fill_in_middle(df, middle.Rates(transformed=50, spm=100)).collect())
    assert set(forms) == {"plain", "spm"} and 60 < forms["spm"] < 140
    assert plain(middle.fill_in_middle(df, middle.Rates(seed=8))) != plain(middle.fill_in_middle(df))


def test_rotation_and_way_back():
    buffer = bytearray(b"0123456789")
    middle.rotate(buffer, 2, 5, 9)
    assert buffer == b"0156782349"
    for i in range(300):
        text = "".join(np.random.default_rng(i).choice(list("ab\n<PSM>é"), i % 40)).encode()
        output, form, *_ = middle.transform(text, i)
        assert middle.restore(output, form) == text


# ---- alignment

def aligned_by_hand(rows):
    import sentencepiece
    from tokenizers import Tokenizer
    ta, tb = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    ta.encode_special_tokens = True
    mark = alignment._byte_of_mark()
    docs = []
    for doc_id, text in rows:
        a, b = ([], []) if not text else (ta.encode(" " + text, add_special_tokens=False).ids, tb.encode(text))
        xa = [bytes(mark[c] for c in ta.id_to_token(i)) for i in a]
        xb = [(bytes([int(p[3:5], 16)]) if tb.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, tb.id_to_piece(i)) for i in b)]
        if not text or b"".join(xa) != (" " + text).encode() or b"".join(xb) != (" " + text).encode():
            docs.append((doc_id, [], [], []))
            continue
        ends_a, ends_b = ({int(e): k for k, e in enumerate(np.cumsum([len(x) for x in xs]))} for xs in (xa, xb))
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            groups.append((a[i:ends_a[e] + 1], b[j:ends_b[e] + 1]))
            i, j = ends_a[e] + 1, ends_b[e] + 1
        docs.append((doc_id, a, b, groups))
    counts = Counter((g[0][-1], g[1][-1]) for d in docs for g in d[3])
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for doc_id, a, b, groups in docs:
        links = [(g[0][-1], g[1][-1]) for g in groups]
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((doc_id, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), sha(spelled) if groups else ""))
    return sorted(out, key=repr)


@pytest.mark.parametrize("work", [1 << 16, 7])
def test_merge_path(work):
    for i in range(40):
        r = np.random.default_rng(i)
        a, b = (np.flatnonzero(r.random(200) < r.random()) for _ in range(2))
        x, y = alignment.common_ends(a, b, work)
        assert np.array_equal(a[x], np.intersect1d(a, b)) and np.array_equal(a[x], b[y])
        cut_a, cut_b = alignment.merge_path(a, b, work)
        sizes = np.diff(cut_a) + np.diff(cut_b)
        assert cut_a[-1] == len(a) and cut_b[-1] == len(b) and (not len(sizes) or (sizes.min() >= 0 and sizes.max() <= work + 1))


def test_alignment_by_hand(odd, docs_of, prose):
    rows = [(i, prose(i % 25, 80)) for i in range(60)]
    rows += [(100, " leading  and   blanks \n\n\t x "), (101, "<|endoftext|> in text <s> </s> <unk> <0x41>"), (102, "a ▁ mark"), (103, "日本語 émile ½ 😀"), (104, "a" * 5000), (105, " "), (106, "\n"), (107, "a\x00b"), (107, "don't we'll 12345 6.7")]
    df = docs_of(rows).unionByName(odd)
    want = aligned_by_hand([(r["doc_id"], r["text"]) for r in df.collect()])
    assert plain(alignment.digest(alignment.align(df.repartition(5), BYTES, PIECES))) == want
    assert [w for w in want if w[1] == 0] and all(w[3] == w[4] for w in want)


def test_alignment_keeps_groups(docs_of):
    row = alignment.align(docs_of([(1, "unbelievable words")]), BYTES, PIECES, keep_groups=True).first()
    assert sha(row["groups"]) == row["groups_sha256"] and len(row["groups"].split(";")) == row["n_groups"]


def test_alignment_in_small_chunks(docs_of, prose, monkeypatch):
    df = docs_of([(i, prose(i, 50)) for i in range(30)])
    whole = plain(alignment.align(df.coalesce(1), BYTES, PIECES))
    assert plain(alignment.align(df.repartition(7), BYTES, PIECES)) == whole
