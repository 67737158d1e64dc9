"""Plain-Python oracles for tests, by other means than the library's.

Words are linked lists of ids; the trainer keeps, for each pair, the set of
(word, place) at which it stands, and the encoder a heap of (rank, place).
"""

import heapq


class Chain:
    """A word as a doubly linked list over its original places."""

    def __init__(self, ids):
        n = len(ids)
        self.ids, self.left, self.right = list(ids), list(range(-1, n - 1)), [*range(1, n), -1]

    def pair(self, i):
        j = self.right[i] if i >= 0 else -1
        return (self.ids[i], self.ids[j]) if j >= 0 else None

    def join(self, i, new_id):
        """Put ``new_id`` at ``i`` in place of it and its right neighbour."""
        gone = self.right[i]
        after = self.right[gone]
        self.ids[i], self.ids[gone], self.right[i], self.left[gone] = new_id, None, after, None
        if after >= 0:
            self.left[after] = i

    def places(self):
        i = 0 if self.ids else -1
        while i >= 0:
            yield i
            i = self.right[i]

    def alive(self, i):
        return self.ids[i] is not None


def encode_word(merges, data: bytes):
    ranks = {pair: rank for rank, pair in enumerate(merges)}
    chain = Chain(data)
    heap = [(ranks[p], i, p) for i in chain.places() if (p := chain.pair(i)) in ranks]
    heapq.heapify(heap)
    while heap:
        rank, i, pair = heapq.heappop(heap)
        if not chain.alive(i) or chain.pair(i) != pair:
            continue
        chain.join(i, 256 + rank)
        for k in (chain.left[i], i):
            p = chain.pair(k) if k >= 0 else None
            if p in ranks:
                heapq.heappush(heap, (ranks[p], k, p))
    return [chain.ids[i] for i in chain.places()]


def train(words, num_merges):
    """Merges of ``words``: (ids, frequency) in first-seen order.

    A pair counts once for each word that holds it.  The most frequent pair
    goes first; of equals, the one that stands first in the corpus.
    """
    chains = [(Chain(ids), freq) for ids, freq in words]
    holders: dict = {}  # pair -> word -> places; places are original ones, so their order is that of the pairs
    weight: dict = {}

    def add(pair, w, i):
        places = holders.setdefault(pair, {}).setdefault(w, set())
        if not places:
            weight[pair] = weight.get(pair, 0) + chains[w][1]
        places.add(i)

    def drop(pair, w, i):
        places = holders.get(pair, {}).get(w)
        if places is None or i not in places:
            return
        places.remove(i)
        if not places:
            del holders[pair][w]
            weight[pair] -= chains[w][1]
            if not holders[pair]:
                del holders[pair], weight[pair]

    for w, (chain, _) in enumerate(chains):
        for i in chain.places():
            if pair := chain.pair(i):
                add(pair, w, i)
    merges = []
    while len(merges) < num_merges and holders:
        most = max(weight.values())
        best = min((p for p in weight if weight[p] == most), key=lambda p: (w := min(holders[p]), min(holders[p][w])))
        new_id = 256 + len(merges)
        merges.append(best)
        places = holders.pop(best)
        del weight[best]
        for w in sorted(places):
            chain = chains[w][0]
            for i in sorted(places[w]):
                if not chain.alive(i) or chain.pair(i) != best:
                    continue
                for k in (chain.left[i], chain.right[i]):
                    if k >= 0 and (old := chain.pair(k)):
                        drop(old, w, k)
                chain.join(i, new_id)
                for k in (chain.left[i], i):
                    if k >= 0 and (new := chain.pair(k)):
                        add(new, w, k)
    return merges
