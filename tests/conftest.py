import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tillwork.session import build_session
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="8g", spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def star(spark):
    from tillwork.sources import StarShop
    return StarShop(spark, SMALL)


CSV = {
    "users": """id,first_name,last_name,email,age,gender,state,street_address,postal_code,city,country,latitude,longitude,traffic_source,created_at
1,Ann,"O""Neil, Jr",a@x,17,F,S,"1 Road
Flat 2",1,C,France,0,0,Search,2023-01-05 08:00:00.123456 UTC
2,Bob,Ray,b@x,18,M,S,R,1,C,France,0,0,Email,2023-01-20 08:00:00 UTC
3,Cy,Lee,c@x,64,M,S,R,1,C,Japan,0,0,Search,2023-02-01 08:00:00.5 UTC
4,Di,Kim,d@x,65,F,S,R,1,C,Japan,0,0,Email,2023-02-02 08:00:00 UTC
5,Ed,Orr,e@x,200,,S,R,1,C,,0,0,Search,2023-02-03 08:00:00 UTC
6,Flo,Fox,f@x,,F,S,R,1,C,Chile,0,0,Display,broken
""",
    "products": """id,cost,category,name,brand,retail_price,department,sku,distribution_center_id
10,4.0,Jeans,Blue,Acme,10.0,Women,s1,1
11,30.0,Jeans,Gold,,40.0,Men,s2,2
12,5.0,Swim,Short,Wave,0.0,Men,s3,1
""",
    "orders": """order_id,user_id,status,gender,created_at,returned_at,shipped_at,delivered_at,num_of_item
100,1,Complete,F,2023-03-01 10:00:00 UTC,,,,2
101,1,Shipped,F,2023-05-01 10:00:00 UTC,,,,1
102,2,Returned,M,2023-03-15 10:00:00 UTC,,,,1
103,3,Complete,M,2023-03-20 10:00:00 UTC,,,,1
104,4,Cancelled,F,2023-04-01 10:00:00 UTC,,,,1
105,5,Complete,,2023-04-02 10:00:00 UTC,,,,1
""",
    "order_items": """id,order_id,user_id,product_id,inventory_item_id,status,created_at,shipped_at,delivered_at,returned_at,sale_price
1000,100,1,10,500,Complete,2023-03-01 10:00:00.250 UTC,2023-03-02 00:00:00 UTC,2023-03-04 12:00:00 UTC,,10.0
1001,100,1,11,501,Complete,2023-03-01 10:00:00 UTC,2023-03-02 00:00:00 UTC,2023-05-01 00:00:00 UTC,,40.0
1002,101,1,10,502,Shipped,2023-05-01 10:00:00 UTC,2023-05-02 00:00:00 UTC,,,9.0
1003,102,2,12,503,Returned,2023-03-15 10:00:00 UTC,2023-03-16 00:00:00 UTC,2023-03-16 00:00:00 UTC,2023-03-20 00:00:00 UTC,0.0
1004,103,3,10,504,Complete,2023-03-20 10:00:00 UTC,2023-03-19 00:00:00 UTC,2023-03-18 00:00:00 UTC,,11.0
1005,104,4,12,505,Cancelled,2023-04-01 10:00:00 UTC,,,,-3.0
1006,105,5,12,506,Complete,2023-04-02 10:00:00 UTC,2023-04-03 00:00:00 UTC,2023-05-31 21:36:00 UTC,,25.0
1007,105,5,99,507,Mystery,2023-04-02 10:00:00 UTC,,,,7.0
1008,105,5,10,508,,2023-04-02 10:00:00 UTC,,,,
""",
    "inventory_items": """id,product_id,created_at,sold_at,cost,product_category,product_name,product_brand,product_retail_price,product_department,product_sku,product_distribution_center_id
500,10,2023-01-01 00:00:00 UTC,2023-01-02 12:00:00 UTC,4.0,Jeans,Blue,Acme,10.0,Women,s1,1
501,11,2023-01-01 00:00:00 UTC,,30.0,Jeans,Gold,,40.0,Men,s2,2
502,10,2023-01-01 00:00:00 UTC,,4.0,Jeans,Blue,Acme,10.0,Women,s1,1
503,12,2023-01-01 00:00:00 UTC,,5.0,Swim,Short,Wave,0.0,Men,s3,1
504,10,2023-01-01 00:00:00 UTC,,4.0,Jeans,Blue,Acme,10.0,Women,s1,2
506,12,2023-01-01 00:00:00 UTC,,5.0,Swim,Short,Wave,0.0,Men,s3,1
""",
    "distribution_centers": """id,name,latitude,longitude
1,North,0,0
2,South,0,0
""",
    "events": """id,user_id,sequence_number,session_id,created_at,ip_address,city,state,postal_code,browser,traffic_source,uri,event_type
1,1,1,s,2023-03-01 09:00:00 UTC,i,c,s,1,b,Search,/home,home
""",
}


@pytest.fixture(scope="session")
def csv_folder(tmp_path_factory):
    folder = tmp_path_factory.mktemp("csv")
    for name, text in CSV.items():
        (folder / f"{name}.csv").write_text(text)
    return str(folder)


@pytest.fixture(scope="session")
def shop(spark, csv_folder):
    from tillwork.sources import CsvShop
    return CsvShop(spark, csv_folder)
