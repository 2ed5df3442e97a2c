"""Plain, slow versions of the operators for comparison on small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def lower_ascii(text: str) -> str:
    return text.translate(_LOWER)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def fingerprint(text: str | None, k: int = 4) -> int:
    from xxhash import xxh64_intdigest
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    grams = [words[i:i + k] for i in range(len(words) - k + 1)] or [words]
    hashes = [xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows: list[tuple], max_bits: int = 4, k: int = 4) -> dict[int, tuple[str, int | None]]:
    """row number -> (fingerprint, smallest id reachable)."""
    fps = [fingerprint(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    distinct = {}
    for i, f in enumerate(fps):
        if f in distinct:
            parent[find(i)] = find(distinct[f])
        else:
            distinct[f] = i
    heads = list(distinct.items())
    for a, (f, i) in enumerate(heads):
        for g, j in heads[a + 1:]:
            if (f ^ g).bit_count() <= max_bits:
                parent[find(i)] = find(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        r = find(i)
        low[r] = min([x for x in (low.get(r), doc) if x is not None], default=None)
    return {i: (f"{fps[i]:016x}", low[find(i)]) for i in range(len(rows))}


def contamination(docs: list[tuple], items: list[tuple]) -> list[tuple]:
    windows: dict[tuple, set] = {}
    lengths = set()
    for item_id, text in items:
        w = BENCH_WORD.findall(lower_ascii(text or ""))
        if w:
            n = min(13, len(w))
            lengths.add(n)
            for i in range(len(w) - n + 1):
                windows.setdefault(tuple(w[i:i + n]), set()).add(item_id)
    out = []
    for doc_id, text in docs:
        w = BENCH_WORD.findall(lower_ascii(text or ""))
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i:i + n]))
                if ids:
                    hit.update(range(i, i + n))
                    found |= ids
        found.discard(None)
        names = sorted(str(x) for x in found)
        out.append((doc_id, len(w), len(hit), len(names), sha(",".join(names)),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def check_pieces(pieces: list[dict], docs: list[tuple], path: str, capacity: int = 4096, end_id: int = 2) -> float:
    """Asserts that `pieces` is an exact packing of `docs`; the padding share."""
    from collections import Counter, defaultdict

    import numpy as np
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    wanted = Counter()
    ids_of = defaultdict(list)
    for doc_id, text in docs:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [end_id]
        wanted[(doc_id, tuple(ids))] += 1
        if ids not in ids_of[doc_id]:
            ids_of[doc_id].append(ids)
    by_seq = defaultdict(list)
    for p in pieces:
        by_seq[p["sequence_id"]].append(p)
        assert any(len(i) == p["doc_tokens"] and zlib.crc32(
            np.array(i[p["start"]:p["start"] + p["length"]], dtype="<u4").tobytes()) == p["ids_crc32"]
            for i in ids_of[p["doc_id"]]), p
    total = padding = 0
    for seq in by_seq.values():
        at = 0
        for p in sorted(seq, key=lambda p: p["offset"]):
            assert p["offset"] == at and p["length"] > 0
            at += p["length"]
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert total == sum(len(ids) * n for (_, ids), n in wanted.items())
    per_doc = defaultdict(list)
    for p in pieces:
        per_doc[p["doc_id"]].append((p["start"], p["length"]))
    for doc_id, spans in per_doc.items():
        copies = sum(n for (d, _), n in wanted.items() if d == doc_id)
        if copies == 1:
            at = 0
            for start, length in sorted(spans):
                assert start == at
                at += length
            assert at == len(ids_of[doc_id][0])
    return padding / max(1, total)


SECRET_BASE = [
    ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 24),
]


def secrets(text: str | None, rules=SECRET_BASE) -> list[tuple[str, int, int]]:
    found = []
    for n, (kind, regex, group, least) in enumerate(rules):
        for m in regex.finditer(text or ""):
            if len(m[group]) >= least:
                found.append((m.start(), n, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


def quality_measures(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    from collections import Counter
    counts = Counter(grams)
    hit = {j for i, g in enumerate(grams) if counts[g] > 1 for j in (i, i + 1, i + 2)}
    return {"n_words": len(words), "word_chars": sum(map(len, words)),
            "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
            "base_failed": len(words) < 50 or 100 * len(hit) > 50 * len(words)}


def repeated_chunks(rows: list[tuple]) -> list[list[tuple[int, int]]]:
    """Chunks removed from each row, by comparing chunk bytes directly."""
    from orebridge.llm.linededup import line_chunks
    first: dict[bytes, tuple] = {}
    chunks = []
    for i, (doc_id, text) in enumerate(rows):
        lines = (text or "").encode().split(b"\n")
        own = [(a, b, b"\n".join(lines[a:b])) for a, b in line_chunks(lines)] if text else []
        chunks.append(own)
        for a, _, body in own:
            place = (doc_id is None, doc_id or 0, a)
            first[body] = min(first.get(body, place), place)
    return [[(a, b) for a, b, body in own if first[body] != (rows[i][0] is None, rows[i][0] or 0, a)]
            for i, own in enumerate(chunks)]
