"""Random keys of every encoding, planted at 24 to 128 characters."""
import random
import string

import numpy as np
import pytest

from barpanel.llm import secrets
from tests.llm.helpers import docs, prose

KEYS = {"base32": string.ascii_uppercase + "234567",
        "base32 lower": string.ascii_lowercase + "234567",
        "base36": string.digits + string.ascii_uppercase,
        "base36 lower": string.digits + string.ascii_lowercase,
        "base62": string.ascii_letters + string.digits,
        "base64": string.ascii_letters + string.digits + "+/"}


@pytest.mark.parametrize("kind", KEYS)
@pytest.mark.parametrize("n", [24, 32, 40, 64, 80, 128])
def test_random_keys_are_not_refused(kind, n):
    """No encoding is refused as too uneven for it, least of all the long keys."""
    rng = random.Random(n)
    letters = np.full(26, 1 / 26)
    refused = sum(secrets.p_value("".join(rng.choices(KEYS[kind], k=n)), letters) == 1.0
                  for _ in range(300))
    assert refused <= 9


def test_long_keys_are_found(spark):
    rng = random.Random(4)
    keys = ["".join(rng.choices(a, k=n)) for a in KEYS.values() for n in (64, 80, 128)
            for _ in range(5)]
    texts = [f"{prose(rng, 30)} {k} {prose(rng, 30)}" for k in keys]
    got = {r.doc_id: r.spans for r in secrets.scan(docs(spark, texts)).collect()}
    found = [any(texts[i][s.start:s.end] == k for s in got[i]) for i, k in enumerate(keys)]
    assert sum(found) >= 0.95 * len(keys)
