import json

from conftest import SF_SMALL


def test_cli_batch_is_idempotent(spark, capsys):
    from seriesrel.__main__ import main
    from seriesrel.session import scratch_path
    from seriesrel.sources import fixtures as fx
    root = scratch_path(spark, "t-cli")
    fx.lead_series(spark, SF_SMALL).write.parquet(f"{root}/lead")
    fx.reference_series(spark, SF_SMALL).write.parquet(f"{root}/ref")
    args = ["batch", "--lead", f"{root}/lead", "--reference", f"{root}/ref",
            "--tables", f"{root}/tables", "--no-changepoints"]
    main(args)
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    main(args)
    second = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["aligned_bars"] > 0 and first["relationship_metrics"] > 0
    assert second == {"aligned_bars": 0, "relationship_metrics": 0, "alerts": 0}
