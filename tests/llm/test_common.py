"""The folder for written steps."""

import types

import pytest

from reelsieve.llm import common


def session(master, setting=None):
    conf = types.SimpleNamespace(get=lambda key, default=None: setting or default)
    context = types.SimpleNamespace(master=master, applicationId="app-of-the-test", getConf=lambda: conf)
    return types.SimpleNamespace(conf=conf, sparkContext=context)


def test_the_setting_comes_first_and_only_local_mode_does_without():
    assert common.shared_dir(session("spark://host:7077", "hdfs://shared/steps")) == "hdfs://shared/steps"
    with pytest.raises(ValueError):
        common.shared_dir(session("spark://host:7077"))
    first = common.shared_dir(session("local[2]"))
    assert first.startswith("file:///") and common.shared_dir(session("local[2]")) == first
