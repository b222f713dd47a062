"""Plain versions that tests compare with."""


def classes(n, linked):
    """Smallest index that each of ``n`` items can reach over ``linked`` index pairs."""
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return [root(x) for x in range(n)]


def smallest_ids(ids, linked):
    """For every item the smallest non-NULL id of its component."""
    roots = classes(len(ids), linked)
    least = {}
    for root, i in zip(roots, ids, strict=True):
        if i is not None:
            least[root] = min(i, least.get(root, i))
    return [least.get(r) for r in roots]
