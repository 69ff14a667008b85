"""Plain-Python definitions that the Spark operators are compared with."""

import json
from collections import defaultdict


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            above, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, above + (x != y))
    return row[-1]


def name_pairs(left, right, reach):
    found = set()
    for a in left:
        for b in right:
            if a[:3] == b[:3] and abs(len(a) - len(b)) <= reach:
                d = distance(a, b)
                if d <= reach:
                    found.add((a, b, d))
    return found


def record_pairs(left, right, rule):
    """``left`` and ``right`` are lists of (record id, name)."""
    out = []
    for lid, a in left:
        for rid, b in right:
            if rule.id_order and not lid < rid:
                continue
            if rule.drop_empty and (not a or not b):
                continue
            if a[:3] != b[:3]:
                continue
            d = distance(a, b)
            score = 1.0 - d / rule.threshold
            if d <= rule.threshold and score >= rule.min_confidence:
                out.append((lid, rid, d, score))
    return out


def least_in_component(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        parent.setdefault(a, a)
        parent.setdefault(b, b)
        parent[root(a)] = root(b)
    members = defaultdict(list)
    for n in parent:
        members[root(n)].append(n)
    return {n: min(group) for group in members.values() for n in group}


def letter_pair_scorer(least: float = 0.85):
    """Offline stand-in for the service: the share of two-letter sequences two names have in
    common, a match from ``least`` on."""

    def letter_pairs(name: str | None) -> set[str]:
        name = name or ""
        return {name[i:i + 2] for i in range(len(name) - 1)}

    def scorer(request: str) -> str:
        results = []
        for pair in json.loads(request)["pairs"]:
            left = letter_pairs(pair["left_company_name"])
            right = letter_pairs(pair["right_company_name"])
            share = len(left & right) / len(left | right) if left | right else 0.0
            results.append({
                "left_id": pair["left_id"], "right_id": pair["right_id"],
                "match": share >= least, "match_confidence": share,
            })
        return json.dumps({"results": results})

    return scorer
