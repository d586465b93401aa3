"""A plain count-and-divide version of the trigram scores, for comparison."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [*WORD.findall(low), "</s>"]


def held_out(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 7 == 2


def score_all(docs: list[tuple[int, str | None]]) -> dict[int, dict]:
    uni, bi, tri = Counter(), defaultdict(Counter), defaultdict(Counter)
    for i, text in docs:
        if not held_out(i):
            seq = words(text)
            uni.update(seq)
            for k, w in enumerate(seq):
                bi[seq[k - 1] if k else "<s>"][w] += 1
                if k:
                    tri[seq[k - 2] if k > 1 else "<s>", seq[k - 1]][w] += 1
    total, size = sum(uni.values()), len(uni)
    out = {}
    for i, text in docs:
        seq, base, score = words(text), 0.0, 0.0
        for k, w in enumerate(seq):
            p = (uni[w] + 1) / (total + size + 1)
            base += math.log10(p)
            contexts = [bi.get(seq[k - 1] if k else "<s>")]
            if k:
                contexts.append(tri.get((seq[k - 2] if k > 1 else "<s>", seq[k - 1])))
            for c in contexts:
                if c:
                    n, t = sum(c.values()), len(c)
                    p = c[w] / (n + t) + t / (n + t) * p
            score += math.log10(p)
        out[i] = {"held_out": held_out(i), "n_tokens": len(seq), "n_known": sum(w in uni for w in seq), "train_tokens": total, "base_score": base, "score": score}
    return out
