"""Version claims on a store without atomic create, with callers stopped between any two steps."""

import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest

from tabforge.operators.runs import _Folder, claim_version, register_model


class SlowStore:
    """Names in a set; every call dawdles before and after, and creating a name twice is not noticed."""

    def __init__(self, seed):
        self.path, self.held, self.random = "memory", set(), random.Random(seed)

    def dawdle(self):
        time.sleep(self.random.choice([0, 0, 0.001, 0.004]))

    def create(self, name):
        self.dawdle()
        self.held.add(name)
        self.dawdle()

    def delete(self, name):
        self.dawdle()
        self.held.discard(name)

    def names(self):
        self.dawdle()
        seen = set(self.held)
        self.dawdle()
        return seen


@pytest.mark.parametrize("seed", range(8))
def test_versions_are_unique_and_without_gaps(seed):
    tickets, entering = SlowStore(seed), SlowStore(seed + 100)
    start = threading.Barrier(8)

    def writer(_):
        start.wait()
        return [claim_version(tickets, entering, pause=0.001) for _ in range(5)]

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(writer, range(8)))
    assert sorted(v for own in got for v in own) == list(range(1, 41))
    assert all(own == sorted(own) for own in got) and not entering.held


def test_an_abandoned_entrance_stops_others_instead_of_doubling_a_version():
    tickets, entering = SlowStore(1), SlowStore(2)
    entering.create("gone")
    with pytest.raises(TimeoutError, match="gone"):
        claim_version(tickets, entering, patience=0.05)
    entering.delete("gone")
    assert claim_version(tickets, entering) == 2  # the ticket of the one who gave up keeps its place


def test_on_the_shared_file_system(spark, tmp_path):
    folder = lambda k: _Folder(spark, str(tmp_path / k))
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda _: claim_version(folder("tickets"), folder("entering")), range(16)))
    assert sorted(got) == list(range(1, 17))


def test_versions_go_on_after_claims_of_the_older_layout(spark, tmp_path):
    at = tmp_path / "model_versions" / "name=m"
    at.mkdir(parents=True)
    for n in ("1", "2"):
        (at / n).touch()
    assert [register_model(spark, str(tmp_path), "m", r, "/r") for r in "ab"] == [3, 4]
