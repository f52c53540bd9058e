import pytest

from claimsight.operators.gate import QualityGateError, assert_quality_gate, gate_checks


def test_gate_has_all_checks_and_blocks(rel):
    rows = gate_checks(rel).collect()
    assert len(rows) == 17 and len({r.test_id for r in rows}) == 17
    with pytest.raises(QualityGateError):
        assert_quality_gate(rel)
