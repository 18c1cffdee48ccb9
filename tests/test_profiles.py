import pytest

from tidemark.profiles import PROFILES, metric_spec, resolve_profile


@pytest.mark.parametrize("name", list(PROFILES))
def test_declarations_hang_together(name):
    profile = PROFILES[name]
    columns = set(profile.schema.names)
    assert set(profile.sensitive) <= columns
    assert set(profile.vocabulary) <= columns
    assert profile.metric[1] in ("max", "mean")
    assert profile.signal


@pytest.mark.parametrize("given, found", [(None, "ROBOTICS"), (" clinical ", "CLINICAL")])
def test_resolve(given, found):
    assert resolve_profile(given).name == found


def test_unknown_profile_names_the_valid_ones():
    with pytest.raises(ValueError, match="MANUFACTURING"):
        resolve_profile("farming")


def test_metric_of_unknown_profile_is_the_default():
    assert metric_spec("farming") == ("mean_signal", "mean")
    assert metric_spec("robotics") == ("peak_torque_nm", "max")
