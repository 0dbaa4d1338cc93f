"""BM25 inverted index with block-max WAND.

Documents are numbered by length, so that neighbours have like impacts.  A
posting list is cut into blocks of documents with the same numbers for all
terms (``block`` documents each), and every list knows the greatest impact
of each block in which it has postings (and of no other, so the index grows
with its postings).  A query first adds up, for each block, the block maxima of
its terms: blocks that cannot reach the threshold are never opened.  In the
others the cursors move as in WAND: they are ordered by document, the first
at which the summed bounds reach the threshold is the pivot, the block
maxima are asked again for the pivot's block, and only then is a document scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

K1, B = 1.2, 0.75


def idf(df: np.ndarray, n: int) -> np.ndarray:
    return np.log1p((n - df + 0.5) / (df + 0.5))


@dataclass
class BlockMaxIndex:
    """Postings in term order: ``docs[at[t]:at[t + 1]]`` with ``impacts``; entries ``of[t]:of[t + 1]`` are the term's blocks with their maxima."""

    terms: np.ndarray  # sorted hashes
    at: np.ndarray
    docs: np.ndarray
    impacts: np.ndarray
    of: np.ndarray
    entry_block: np.ndarray
    entry_most: np.ndarray
    blocks: int
    names: list
    block: int

    @classmethod
    def build(cls, names: list, words: list[np.ndarray], block: int = 8, scale: bool = False) -> BlockMaxIndex:
        """From the word hashes of each document; ``scale``: impacts are shares of the document's score for itself."""
        order = sorted(range(len(names)), key=lambda i: len(words[i]))
        names, words = [names[i] for i in order], [words[i] for i in order]
        size = np.array([len(w) for w in words], float)
        doc = np.repeat(np.arange(len(names)), size.astype(int))
        term, tid = np.unique(np.concatenate([*words, np.zeros(0, np.uint64)]), return_inverse=True)
        pair, tf = np.unique(tid * max(1, len(names)) + doc, return_counts=True)
        tid, doc = np.divmod(pair, max(1, len(names)))
        df = np.bincount(tid, minlength=len(term))
        norm = K1 * (1 - B + B * size / max(size.mean() if len(size) else 1.0, 1e-9))
        impact = idf(df, len(names))[tid] * tf * (K1 + 1) / (tf + norm[doc])
        if scale:
            own = np.bincount(doc, impact, minlength=len(names))
            impact = impact / np.maximum(own, 1e-9)[doc]
        impact = np.nextafter(impact.astype(np.float32), np.float32(np.inf))
        own = doc // block
        new = np.flatnonzero((np.diff(tid, prepend=-1) != 0) | (np.diff(own, prepend=-1) != 0))
        most = np.maximum.reduceat(impact, new) if len(new) else np.zeros(0, np.float32)
        of = np.searchsorted(tid[new], np.arange(len(term) + 1))
        return cls(term, np.searchsorted(tid, np.arange(len(term) + 1)), doc, impact, of, own[new], most, max(1, (len(names) + block - 1) // block), names, block)

    def term_ids(self, h: np.ndarray) -> np.ndarray:
        """Number of each hash's term, -1 if it isn't in the index."""
        if not len(self.terms):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.terms, h), len(self.terms) - 1)
        return np.where(self.terms[at] == h, at, -1)

    def bounds(self, tid: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Summed block maxima of many queries at once: query i has the terms from ``first[i]`` on; queries x blocks."""
        n = self.of[tid + 1] - self.of[tid]
        query = np.repeat(np.searchsorted(first, np.arange(len(tid)), side="right") - 1, n)
        entry = np.repeat(self.of[tid] - np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64), n) + np.arange(n.sum())
        key = query * self.blocks + self.entry_block[entry]
        return np.bincount(key, self.entry_most[entry], len(first) * self.blocks).reshape(len(first), self.blocks)

    def most(self, tid: np.ndarray, block: int) -> np.ndarray:
        """The greatest impact of each term in a block (0: none)."""
        out = np.zeros(len(tid))
        for i, t in enumerate(tid):
            a, b = self.of[t], self.of[t + 1]
            k = a + np.searchsorted(self.entry_block[a:b], block)
            if k < b and self.entry_block[k] == block:
                out[i] = self.entry_most[k]
        return out

    def search(self, tid: np.ndarray, threshold: float, blocks: np.ndarray) -> list[tuple[object, float]]:
        """All documents of the open ``blocks`` that score at least ``threshold`` for a query of distinct terms."""
        out = []
        for block in blocks:
            lo, hi = block * self.block, (block + 1) * self.block
            most = self.most(tid, block)
            lists = []
            for t, upto in zip(tid[most > 0], most[most > 0]):
                i = self.at[t] + np.searchsorted(self.docs[self.at[t] : self.at[t + 1]], lo)
                j = self.at[t] + np.searchsorted(self.docs[self.at[t] : self.at[t + 1]], hi)
                if i < j:
                    lists.append([int(i), int(j), float(upto)])
            while lists:
                lists.sort(key=lambda x: self.docs[x[0]])
                total, pivot = 0.0, None
                for n, (i, _, most) in enumerate(lists):
                    total += most
                    if total >= threshold:
                        pivot = n
                        break
                if pivot is None:
                    break
                doc = self.docs[lists[pivot][0]]
                if self.docs[lists[0][0]] == doc:
                    score = sum(float(self.impacts[x[0]]) for x in lists if self.docs[x[0]] == doc)
                    if score >= threshold:
                        out.append((self.names[doc], score))
                    for x in lists:
                        x[0] += self.docs[x[0]] == doc
                else:
                    for x in lists[:pivot]:
                        x[0] += int(np.searchsorted(self.docs[x[0] : x[1]], doc))
                lists = [x for x in lists if x[0] < x[1]]
        return out
