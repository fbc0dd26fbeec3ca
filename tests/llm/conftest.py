from __future__ import annotations

import pytest


@pytest.fixture
def shared(spark, tmp_path):
    return f"file://{tmp_path}/shared"
