from repolens.operators import sinks
from repolens.streaming.landing_stream import load_landed
from tests.jsonland import commit, write_page


def test_landing_stream_loads_each_file_once(spark, workdir):
    landing, root, ck = f"{workdir}/landing", f"{workdir}/wh", f"{workdir}/ckpt"
    sinks.ensure_layers(spark, root)
    sinks.ensure_tables(spark, root)
    write_page(landing, "commits", [commit("s1"), commit("s2")], repo="octo/hello", page=1)
    write_page(landing, "languages", None, repo="octo/hello", raw_text='{"Java": 5, "C": 7}')
    load_landed(spark, landing, root, entities=("commits", "languages"), checkpoint_root_dir=ck)
    raw = sinks.read_raw(spark, root, "raw_commits")
    assert sorted(r.sha for r in raw.collect()) == ["s1", "s2"]
    assert {r.repo_full_name for r in raw.collect()} == {"octo/hello"}
    assert sinks.read_raw(spark, root, "raw_languages").count() == 2
    # rerun without new files: nothing is appended again
    load_landed(spark, landing, root, entities=("commits",), checkpoint_root_dir=ck)
    assert sinks.read_raw(spark, root, "raw_commits").count() == 2
    # a new page: only its rows are appended
    write_page(landing, "commits", [commit("s3")], repo="octo/hello", page=2)
    load_landed(spark, landing, root, entities=("commits",), checkpoint_root_dir=ck)
    assert sorted(r.sha for r in sinks.read_raw(spark, root, "raw_commits").collect()) == ["s1", "s2", "s3"]
