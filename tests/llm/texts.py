"""Invented prose."""

import random

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(50)) for _ in range(n))
