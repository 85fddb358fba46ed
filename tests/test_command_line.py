from test_sources import write_sources

from kinbridge.__main__ import main


def test_load_kpi_counts_sql_and_replay(spark, folder, capsys):
    write_sources(spark, f"{folder}/raw")
    main(["load", "--input", f"{folder}/raw", "--warehouse", f"{folder}/w"])
    assert "'activity_events': 9" in capsys.readouterr().out
    main(["counts", "--warehouse", f"{folder}/w"])
    assert "fact_activity_event" in capsys.readouterr().out
    main(["kpi", "--warehouse", f"{folder}/w"])
    assert "total_platform_fee_usdt" in capsys.readouterr().out
    main(
        ["sql", "--warehouse", f"{folder}/w", "--compat", "--preview", "3",
         "SELECT count(*) AS n FROM dim_customer"]
    )
    assert "|5  |" in capsys.readouterr().out
    main(["replay", "--input", f"{folder}/raw", "--target", f"{folder}/topics"])
    assert "customer_sessions" in capsys.readouterr().out


def test_results_are_whole_unless_a_preview_is_asked(spark, folder, capsys):
    write_sources(spark, f"{folder}/raw")
    main(["load", "--input", f"{folder}/raw", "--warehouse", f"{folder}/w"])
    many = "SELECT explode(sequence(1000, 1060)) AS n"
    capsys.readouterr()
    main(["sql", "--warehouse", f"{folder}/w", many])
    assert sum(line.startswith("10") for line in capsys.readouterr().out.splitlines()) == 61
    main(["sql", "--warehouse", f"{folder}/w", "--output", f"{folder}/out", many])
    assert spark.read.parquet(f"{folder}/out").count() == 61
    main(["kpi", "--warehouse", f"{folder}/w", "--output", f"{folder}/kpi"])
    assert spark.read.parquet(f"{folder}/kpi/daily_active_customers").count() > 0
