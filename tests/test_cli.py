import pytest

from marlstone.__main__ import main
from marlstone.config import Settings
from test_messages import message


def test_settings():
    assert Settings.from_env({}) == Settings() and Settings().gateway == ""
    s = Settings.from_env({"DEDUP_MAXLEN": "7", "PUSHGATEWAY_HOST": "h", "PORT": "1"})
    assert (s.capacity, s.gateway, s.port) == (7, "h:9091", 1)


@pytest.mark.parametrize("streaming", [False, True])
def test_pipeline_from_the_command_line(spark, tmp_path, streaming):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(message("crypto").decode() + "\n{}\n")
    more = ["--stream", "--checkpoint", str(tmp_path / "ck")] if streaming else []
    main(["crypto", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--dead", str(tmp_path / "dead"), *more], spark)
    assert spark.read.parquet(str(tmp_path / "out")).first().product_id == "BTC-USD"
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1
