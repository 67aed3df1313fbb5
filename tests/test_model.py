import pytest

from kubus.model import GEO, PRODUCT, TIME, CubePosition, resolve_levels, validate_metric


def test_levels_resolve_to_columns():
    assert resolve_levels("region", "quarter", "productGroup") == (
        "region_name", "quarter", "product_group_name")
    assert GEO.level_names == ["country", "region", "city", "shop"]
    assert TIME.level_names == ["year", "quarter", "month", "day"]
    assert PRODUCT.level_names[-1] == "article"


def test_bad_level_lists_valid_ones():
    with pytest.raises(ValueError, match="country"):
        resolve_levels("planet", "quarter", "article")
    with pytest.raises(ValueError):
        validate_metric("profit")


def test_position_moves_and_bounds():
    pos = CubePosition()
    assert pos.levels == ("region", "quarter", "productGroup")
    assert pos.drill_down("geo").roll_up("geo") == pos
    top = CubePosition(0, 0, 0)
    with pytest.raises(ValueError, match="above year"):
        top.roll_up("time")
    assert top.roll_up("time", clamp=True) == top
    bottom = CubePosition(3, 3, 3)
    with pytest.raises(ValueError, match="below article"):
        bottom.drill_down("product")
    assert pos.report()["product"] == "productGroup (Level 3/4)"
    with pytest.raises(ValueError):
        CubePosition(4, 0, 0)


def test_cluster_conf_sizes_partitions():
    from kubus.session import cluster_conf
    conf = cluster_conf(shuffle_bytes=20 * 1024 ** 4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 81920
    assert conf["spark.sql.adaptive.enabled"] == "true"
    assert int(cluster_conf(10, 8)["spark.sql.shuffle.partitions"]) == 16
