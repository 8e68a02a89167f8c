"""Groups of near copies by the likeness of all pairs that share a run of words."""


def shingles(text):
    words = (text or "").lower().split()
    if len(words) < 5:
        return {" ".join(words)} if words else set()
    return {" ".join(words[i : i + 5]) for i in range(len(words) - 4)}


def expected_ids(rows):
    """The least id of each component, by brute force over an inverted index."""
    sets, root, holders = [shingles(text) for _, text in rows], list(range(len(rows))), {}
    empty = [i for i, own in enumerate(sets) if not own]
    pairs = [(empty[0], i) for i in empty[1:]]
    for i, own in enumerate(sets):
        common = {}
        for shingle in own:
            for j in holders.setdefault(shingle, []):
                common[j] = common.get(j, 0) + 1
            holders[shingle].append(i)
        pairs += [
            (j, i) for j, both in common.items() if both * 5 >= (len(own) + len(sets[j]) - both) * 4
        ]

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in pairs:
        root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [least[find(i)] for i in range(len(rows))]
