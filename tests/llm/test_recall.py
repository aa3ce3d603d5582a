"""The Jaccard join on given documents against all pairs that share a shingle, compared exactly."""

import re
from collections import Counter, defaultdict

from gridloom.llm import jaccard_join


def test_jaccard_join_equals_brute_force_on_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    sets = {}
    for doc_id, text in docs.collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()
    holders = defaultdict(list)
    for doc_id, own in sets.items():
        for shingle in own:
            holders[shingle].append(doc_id)
    links, root = defaultdict(set), {i: i for i in sets}
    for a, own in sets.items():
        common = Counter(b for shingle in own for b in holders[shingle] if b > a)
        for b, n in common.items():
            if 5 * n >= 4 * (len(own) + len(sets[b]) - n):
                links[a].add(b)
                links[b].add(a)
    for start in sorted(sets):
        todo = [start] if root[start] == start else []
        while todo:
            for other in links[todo.pop()]:
                if root[other] > start:
                    root[other] = start
                    todo.append(other)
    assert sum(map(len, links.values())) > 0
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs).collect()}
    assert got == {i: (root[i], len(links[i])) for i in sets}
