import pytest

from tidestock import session


class Conf:
    def __init__(self, folder, warehouse):
        self.known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}

    def get(self, key, default=None):
        return self.known.get(key) or default


class Context:
    def __init__(self, master):
        self.master = master

    def getCheckpointDir(self):
        return None


class Session:
    def __init__(self, folder, master, warehouse="hdfs://warehouse"):
        self.conf, self.sparkContext = Conf(folder, warehouse), Context(master)


def test_the_session_setting_wins():
    assert session.shared_folder(Session("hdfs://shared/", "yarn")) == "hdfs://shared"


def test_the_warehouse_stands_in():
    assert session.shared_folder(Session(None, "yarn")) == "hdfs://warehouse"


@pytest.mark.parametrize("folder", ["file:///tmp/x", None])
def test_a_cluster_refuses_a_machine_local_folder(folder):
    with pytest.raises(ValueError):
        session.shared_folder(Session(folder, "yarn", warehouse="file:/tmp/warehouse"))


def test_a_local_session_may_use_local_files():
    assert session.shared_folder(Session("file:///tmp/x", "local[4]")) == "file:///tmp/x"


def test_staged_keeps_rows_and_schema(spark):
    df = spark.range(10).selectExpr("id", "cast(id as string) as text")
    again = session.staged(df, "t")
    assert again.dtypes == df.dtypes and again.exceptAll(df).count() == 0
