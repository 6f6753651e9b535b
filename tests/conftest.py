import datetime as dt
import sys

import pytest

from dimloom.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
        # A handful of rows does not repay compiling; test_oracle turns code generation on.
        spark__sql__codegen__wholeStage="false", spark__sql__codegen__factoryMode="NO_CODEGEN",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def day():
    return lambda text: dt.date.fromisoformat(text)
