import random

import pytest


@pytest.fixture
def rng():
    return random.Random(17)


@pytest.fixture(scope="session")
def words():
    draw = random.Random(3)
    return ["".join(draw.choice("abcdeéü") for _ in range(draw.randint(1, 7))) for _ in range(300)]
