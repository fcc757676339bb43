import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lakestrata.session import build_session

    shared = tmp_path_factory.mktemp("shared")
    session = build_session(
        "tests",
        spark__master="local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="8g",
        spark__checkpoint__dir=str(shared),
        spark__sql__warehouse__dir=str(shared / "warehouse"),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(tmp_path):
    from lakestrata.layout import Layout

    return Layout(str(tmp_path))


def put(path: str, text: str) -> None:
    target = Path(path)
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


@pytest.fixture
def shop(lake):
    """Small dirty deliveries of all three sources."""
    put(
        lake.raw("sales/2022-09-1/s.csv"),
        "CustomerId,PurchaseDate,Product,Price\n"
        "1,2022-09-1,TV,$2000\n"
        '2,2022-09-01, TV ,"$1,500.50"\n'
        "3,2022/09/01,TV,$900\n"
        "4,2022-09-1,Laptop,1 299.99\n"
        "x5,2022-09-1,TV,$100\n"
        "6,2022-09-1,Phone,700USD\n"
        "7,2022-09-1,TV,\n"
        "8,2022-09-1\n"
        ",2022-09-1,TV,$10\n",
    )
    put(
        lake.raw("sales/2022-09-2/s.csv"),
        "CustomerId,PurchaseDate,Product,Price\n2,2022-09-2,TV,$1999.99\n9,2022-09-2,TV,$50,extra\n",
    )
    head = "Id,FirstName,LastName,Email,RegistrationDate,State\n"
    put(
        lake.raw("customers/2022-8-1/c.csv"),
        head
        + "1,Anna,Lee, Anna.Lee@Example.com ,2021-05-1,California\n"
        + "2,,Moore,bob@ex.com,2021-06-12,\n",
    )
    put(
        lake.raw("customers/2022-8-5/c.csv"),
        head
        + "1,Anna,Lee,anna.lee@example.com,2021-05-1,Oregon\n"
        + "2,,Moore,bob@ex.com,2021-06-12,\n",
    )
    put(
        lake.raw("customers/2022-8-10/c.csv"),
        head
        + "1,Anna,Lee,anna.lee@example.com,2021-05-1,Texas\n"
        + "2,  ,Moore,bob@ex.com,2021-06-12,  \n"
        + "3,Cy,,   ,2022-01-3,Ohio\n"
        + "9,,,nine@ex.com,2022-02-15,Nevada\n",
    )
    put(
        lake.raw("user_profiles/p.json"),
        '{"email":"ANNA.LEE@example.com ","full_name":"Anna Lee","state":"Texas","birth_date":"1995-03-10","phone_number":"555-0001"}\n'
        '{"email":"bob@ex.com","full_name":"Bob Moore","state":"Utah","birth_date":"2002-12-31","phone_number":"555-0002"}\n'
        '{"email":"bob@ex.com","full_name":"Bob Moore","state":"Utah","birth_date":"2002-12-31","phone_number":"555-0002"}\n'
        '{"email":null,"full_name":"No Mail","state":"Ohio","birth_date":"1990-01-01","phone_number":"555-0003"}\n'
        '{"email":"nine@ex.com","full_name":"Nine Van Dyke","state":"Iowa","birth_date":"bad","phone_number":" 555-0009 "}\n',
    )
    return lake
