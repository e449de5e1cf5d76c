import pytest

from wattloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    # tiny inputs: few tasks and no code generation to compile; check_queries and the bench run compiled plans.
    # What is checkpointed or stored goes to folders of the run.
    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests", 4, spark__sql__shuffle__partitions="2", spark__default__parallelism="2",
        spark__sql__codegen__wholeStage="false", spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__checkpoint__dir=f"file://{shared}/checkpoints", spark__sql__warehouse__dir=f"file://{shared}/warehouse")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Sorted plain tuples of a DataFrame."""
    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(x) for x in r))
    return collect
