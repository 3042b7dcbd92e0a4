"""Seed rows of the three reference tables. Ids are 1..n in the order given."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schema as S

# Fixed values.
BRANCHES = (
    ("Downtown Branch", "123 Main St, Cityville", "1112223333"),
    ("Uptown Branch", "456 Market St, Cityville", "4445556666"),
    ("Midtown Branch", "789 Central Ave, Cityville", "7778889999"),
    ("Eastside Branch", "101 East St, Cityville", "2223334444"),
    ("Westside Branch", "202 West St, Cityville", "3334445555"),
    ("Southside Branch", "303 South St, Cityville", "4445556666"),
    ("Northside Branch", "404 North St, Cityville", "5556667777"),
    ("Central Branch", "505 Central Blvd, Cityville", "6667778888"),
    ("Airport Branch", "606 Airport Rd, Cityville", "7778889999"),
    ("Harbor Branch", "707 Harbor Dr, Cityville", "8889990000"),
    ("Suburban Branch", "808 Suburban Ln, Cityville", "9990001111"),
    ("Industrial Branch", "909 Industrial Rd, Cityville", "0001112222"),
    ("University Branch", "1010 College Ave, Cityville", "1112223333"),
)
# Fixed values.
EMPLOYEES = (
    ("John", "Smith", "john.smith1@branch1.com", "555-1001", 1),
    ("Emily", "Johnson", "emily.johnson1@branch1.com", "555-1002", 1),
    ("Michael", "Brown", "michael.brown2@branch2.com", "555-2001", 2),
    ("Sarah", "Davis", "sarah.davis2@branch2.com", "555-2002", 2),
    ("Robert", "Wilson", "robert.wilson3@branch3.com", "555-3001", 3),
    ("Linda", "Taylor", "linda.taylor3@branch3.com", "555-3002", 3),
    ("James", "Martinez", "james.martinez4@branch4.com", "555-4001", 4),
    ("Laura", "White", "laura.white4@branch4.com", "555-4002", 4),
    ("Richard", "Clark", "richard.clark5@branch5.com", "555-5001", 5),
    ("Nancy", "Lewis", "nancy.lewis5@branch5.com", "555-5002", 5),
    ("Christopher", "Walker", "christopher.walker6@branch6.com", "555-6001", 6),
    ("Mary", "Hall", "mary.hall6@branch6.com", "555-6002", 6),
    ("Joseph", "Allen", "joseph.allen7@branch7.com", "555-7001", 7),
    ("Barbara", "Young", "barbara.young7@branch7.com", "555-7002", 7),
    ("Charles", "King", "charles.king8@branch8.com", "555-8001", 8),
    ("Susan", "Wright", "susan.wright8@branch8.com", "555-8002", 8),
    ("David", "Scott", "david.scott9@branch9.com", "555-9001", 9),
    ("Patricia", "Adams", "patricia.adams9@branch9.com", "555-9002", 9),
    ("Daniel", "Baker", "daniel.baker10@branch10.com", "555-10001", 10),
    ("Lisa", "Gonzalez", "lisa.gonzalez10@branch10.com", "555-10002", 10),
    ("Mark", "Perez", "mark.perez11@branch11.com", "555-11001", 11),
    ("Karen", "Lopez", "karen.lopez11@branch11.com", "555-11002", 11),
    ("Steven", "Hill", "steven.hill12@branch12.com", "555-12001", 12),
    ("Sandra", "Edwards", "sandra.edwards12@branch12.com", "555-12002", 12),
    ("Paul", "Green", "paul.green13@branch13.com", "555-13001", 13),
    ("Donna", "Brooks", "donna.brooks13@branch13.com", "555-13002", 13),
)
# Fixed values.
VEHICLE_TYPES = (
    ("Sedan", "Comfortable 4-door cars suitable for families"),
    ("SUV", "Spacious vehicles for off-road and family trips"),
    ("Truck", "Large vehicles for cargo transport"),
    ("Van", "Multi-purpose vehicles suitable for group travels"),
    ("Motorcycle", "Two-wheeled motorized vehicles"),
    ("Convertible", "Cars with retractable roofs"),
    ("Coupe", "Compact and stylish two-door cars designed for individual or couple use"),
    ("Heavy Duty Truck", "Trucks designed for heavy cargo transport"),
    ("Camper", "Recreational vehicles for camping"),
    ("Electric Car", "Vehicles powered entirely by electricity"),
    ("Hybrid Car", "Vehicles powered by a combination of gasoline and electricity"),
    ("Sports Car", "High-performance and stylish cars"),
    ("Compact Car", "Small size and compact vehicles for city roads"),
    ("Minivan", "Family-oriented vehicles with extra seating"),
    ("Pickup Truck", "Light-duty trucks with open cargo areas"),
    ("Luxury SUV", "High-end spacious vehicles for off-road trips with premium features"),
    ("Luxury Sedan", "High-end sedans with premium features"),
)


def seed_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """Branch, employee and vehicle_type as DataFrames."""
    seeds = ((S.BRANCH, BRANCHES), (S.EMPLOYEE, EMPLOYEES), (S.VEHICLE_TYPE, VEHICLE_TYPES))
    return {
        table.name: spark.createDataFrame([(i, *row) for i, row in enumerate(rows, 1)], table.struct)
        for table, rows in seeds
    }
