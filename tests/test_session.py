"""Session helpers: partition sizing and the checkpoint folder rule."""

import os
import subprocess
import sys

from conftest import ROOT
from tillroll.session import checkpoint_dir, default_shuffle_partitions


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        return self.values.get(key, default)


class _Ctx:
    def __init__(self, master, conf=None, current=None):
        self.master, self._conf, self._dir = master, _Conf(conf or {}), current

    def getConf(self):
        return self._conf

    def getCheckpointDir(self):
        return self._dir

    def setCheckpointDir(self, d):
        self._dir = d


class _Session:
    def __init__(self, ctx):
        self.sparkContext = ctx


def test_partitions_follow_input_size():
    assert default_shuffle_partitions(1 << 20) == 8
    assert default_shuffle_partitions(100 << 40) == 819200  # 100 TB / 128 MB


def test_checkpoint_dir_from_cluster_setting():
    ctx = _Ctx("yarn", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert checkpoint_dir(_Session(ctx)) == "hdfs:///shared/ckpt"
    assert ctx.getCheckpointDir() == "hdfs:///shared/ckpt"


def test_no_local_folder_is_picked():
    assert checkpoint_dir(_Session(_Ctx("spark://master:7077"))) is None
    assert checkpoint_dir(_Session(_Ctx("local[2]"))) is None


def test_submitted_settings_are_kept(scratch):
    """A job started with a master and partitions of its own keeps them."""
    code = ("from tillroll.session import job_session; s = job_session(); "
            "print('KEPT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.sql.shuffle.partitions=333 "
           "--conf spark.ui.enabled=false pyspark-shell", "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", code], env=env, cwd=scratch, capture_output=True, text=True, timeout=120)
    assert "KEPT local[2] 333" in out.stdout, out.stderr[-500:]
