"""Sending the package's code to the executors."""

import time
import types
from concurrent.futures import ThreadPoolExecutor

from weekcast.llm.common import ship
from weekcast.session import ship_code


class Cluster:
    """A session whose file server, like Spark's off a local master, refuses a second path of the same name."""

    def __init__(self, app):
        self.files, self.conf = {}, types.SimpleNamespace(get=lambda *_: "1", set=lambda *_: None)
        self.sparkContext = types.SimpleNamespace(applicationId=app, addPyFile=self.add)

    def add(self, path):
        time.sleep(0.05)
        assert self.files.setdefault(path.rsplit("/", 1)[-1], path) == path, "already registered with a different path"


def test_code_is_sent_once_however_many_threads_ask():
    cluster = Cluster("app-of-threads")
    with ThreadPoolExecutor(5) as pool:
        list(pool.map(lambda _: ship_code(cluster), range(5)))
    ship(cluster)                       # the training-data operators' own call
    assert len(cluster.files) == 1
    other = Cluster("another-app")
    ship_code(other)
    assert len(other.files) == 1 and not set(other.files) & set(cluster.files)
