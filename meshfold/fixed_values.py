"""They have to equal the data formats for right results."""

# Tag keys of the mesh files.
IDENTIFIER_KEY = "ref:MLIT_PLATEAU"
BUILDING_KEY = "building"
PART_KEY = "building:part"

# source_dataset is <prefix><5 digit city code>_<file name>.
DATASET_PREFIX = "plateau_"
DATASET_CITY_PATTERN = "plateau_([0-9]{5})_"

# Catalogue formats.
PACKAGE_PATTERN = "^plateau-([0-9]{5})-(.+)-([0-9]{4})$"
RESOURCE_PATTERN = "^CityGML（v([0-9]+)）$"
ARCHIVE_MEMBER_PREFIX = "udx/bldg/"
ARCHIVE_NAME_SUFFIX = "_bldg_6697_op.zip"
MIN_ARCHIVE_BYTES = 1000
PLAN_FIELDS = ("city_code", "package", "year", "citygml_v", "bytes", "url")

# Coordinates are integers in 1e-7 degree.
COORD_SCALE = 10_000_000
MIN_LAT, MAX_LAT, MIN_LON, MAX_LON = 20.0, 46.0, 122.0, 154.0

# Node id = -(1 + (lat_i - LAT_OFFSET) * LON_STEPS + (lon_i - LON_OFFSET)).
LAT_OFFSET = 200_000_000
LON_OFFSET = 1_220_000_000
LAT_STEPS = 260_000_001
LON_STEPS = 320_000_001

# Way id = -(building id * 1000 + ring); relation id = -(building id * 10 + kind).
WAY_RING_STEPS = 1000
RELATION_KIND_STEPS = 10
RELATION_KIND_BUILDING = 1
RELATION_KIND_MULTIPOLYGON = 2

# Shape rules of the import.
METRES_PER_DEGREE = 111320.0
TINY_AREA_M2 = 0.1
HEIGHT_RANGE = (0.5, 300.0)
LEVEL_RANGE = (1, 50)
ELE_RANGE = (-100.0, 9000.0)
TEXT_WIDTHS = {
    "name": 100, "addr_housenumber": 20, "addr_street": 100, "building_material": 50,
    "roof_material": 50, "roof_shape": 50, "start_date": 10, "amenity": 50, "shop": 50,
    "tourism": 50, "leisure": 50, "landuse": 50,
}
VALIDITY_TARGET = 99.9

# Coverage.
CONCAVE_RATIO = 0.5

# Order of the output tags: (tag key, column).
OUTPUT_TAGS = (
    ("height", "height"), ("ele", "ele"), ("building:levels", "building_levels"),
    ("name", "name"), ("addr:housenumber", "addr_housenumber"),
    ("addr:street", "addr_street"), ("start_date", "start_date"),
    ("building:material", "building_material"), ("roof:material", "roof_material"),
    ("roof:shape", "roof_shape"), ("amenity", "amenity"), ("shop", "shop"),
    ("tourism", "tourism"), ("leisure", "leisure"), ("landuse", "landuse"),
)
