"""Recall of near duplicates at their own definition: weighted similarity from 0.8 on, with shingles and weights made here."""

import collections
import math
import random
import re

from millrace.llm.neardup import near_duplicates


def _weights(texts):
    """Weights of each text's shingles of five words: damped counts times 1 to 1.25 by rarity."""
    bags = []
    for text in texts:
        words = re.findall(r"\w+", text.lower())
        bags.append(collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)))
    frequency, n = collections.Counter(s for bag in bags for s in bag), len(texts)
    rare = lambda s: 1 + 0.25 * math.log((n + 1) / (frequency[s] + 1)) / math.log(n + 2)
    return [{s: (1 + math.log(c)) * rare(s) for s, c in bag.items()} for bag in bags]


def _similarity(a, b):
    common = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
    return common / (sum(a.values()) + sum(b.values()) - common)


def test_recall_just_above_the_threshold(spark):
    draw, texts = random.Random(11), []
    for i in range(400):
        words = [f"w{draw.randrange(5000)}" for _ in range(250)]
        copy = list(words)
        for at in draw.sample(range(5, 245), draw.randrange(4, 7)):
            copy[at] = f"e{i}x{at}"
        texts += [" ".join(words), " ".join(copy)]
    weights = _weights(texts)
    found = {r.id: r.class_id for r in near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    near = [(i, _similarity(weights[i], weights[i + 1])) for i in range(0, len(texts), 2)]
    above, below = [i for i, s in near if 0.805 <= s <= 0.9], [i for i, s in near if s < 0.795]
    assert len(above) > 100 and len(below) > 30
    assert sum(found[i] == found[i + 1] for i in above) >= 0.99 * len(above)
    assert not any(found[i] == found[i + 1] for i in below)
