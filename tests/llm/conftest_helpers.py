from collections import defaultdict


def by_id(rows, column):
    out = defaultdict(list)
    for r in rows:
        out[r[column]].append(r)
    return out


class Sets:
    """Union-find for brute-force components."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
