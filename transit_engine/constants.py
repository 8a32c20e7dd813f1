"""Fixed values that results depend on: vocabularies, radii and the configured cities."""

from __future__ import annotations

# Road classes that are kept.
ROAD_CLASSES = [
    "motorway", "trunk", "primary", "secondary", "tertiary",
    "residential", "unclassified", "service",
]

# Point-of-interest category -> group.
POI_GROUPS = {
    "restaurant": "food",
    "fast_food": "food",
    "cafe": "food",
    "school": "education",
    "university": "education",
    "college": "education",
    "hospital": "healthcare",
    "clinic": "healthcare",
    "pharmacy": "healthcare",
    "doctors": "healthcare",
    "supermarket": "grocery",
    "convenience": "grocery",
    "greengrocer": "grocery",
    "library": "civic",
    "bank": "civic",
    "post_office": "civic",
    "community_centre": "civic",
    "police": "civic",
    "fire_station": "civic",
    "place_of_worship": "civic",
    "park": "park",
    "playground": "park",
    "garden": "park",
    "stadium": "entertainment",
    "museum": "entertainment",
}

# Map tag key -> accepted tag values, in order of precedence.
POI_TAGS = {
    "amenity": [
        "restaurant", "fast_food", "cafe", "school", "university", "college",
        "hospital", "clinic", "pharmacy", "doctors", "library", "bank",
        "post_office", "community_centre", "police", "fire_station", "place_of_worship",
    ],
    "shop": ["supermarket", "convenience", "greengrocer"],
    "leisure": ["park", "playground", "garden"],
    "tourism": ["museum"],
    "building": ["stadium"],
}

# Category and group sets behind the access measures.
CRITICAL_GROUPS = ["healthcare", "education", "grocery"]
SCHOOL_CATEGORIES = ["school", "university", "college"]
HOSPITAL_CATEGORIES = ["hospital", "clinic"]

# Distances in metres and search boxes in degrees (latitude, longitude).
EARTH_RADIUS_M = 6_371_000
POI_RADIUS_M = 400
POI_BOX_DEG = (0.004, 0.005)
ROAD_RADIUS_M = 200
ROAD_BOX_DEG = (0.002, 0.003)

# Result limits.
STOP_LIMIT = 200
ROUTE_LIMIT = 25
CATALOG_LIMIT = 500
PREVIEW_STOPS = 12
DETAIL_STOPS = 80

# Life time of a live record, and the bounds on the gap between two updates.
LIVE_TTL_SECONDS = 180
GAP_MIN_MS = 900
GAP_MAX_MS = 3200
GAP_FALLBACK_MS = 1800

# Slug, display name, latitude, longitude, zoom, batch?, live?
CITIES = [
    ("boston", "Boston", 42.3601, -71.0589, 11.2, True, True),
    ("chicago", "Chicago", 41.8781, -87.6298, 10.6, True, True),
]

# Display texts.
ROUTE_TYPE_LABELS = {
    0: "Light rail",
    1: "Subway",
    2: "Commuter rail",
    3: "Bus",
    4: "Ferry",
}
AMENITY_GROUP_LABELS = {
    "food": "Food and cafes",
    "education": "Education",
    "healthcare": "Healthcare",
    "grocery": "Groceries",
    "civic": "Civic places",
    "park": "Parks",
    "entertainment": "Entertainment",
    "other": "Other amenities",
}
POI_CATEGORY_LABELS = {
    "restaurant": "restaurants",
    "fast_food": "quick food",
    "cafe": "cafes",
    "school": "schools",
    "university": "universities",
    "college": "colleges",
    "hospital": "hospitals",
    "clinic": "clinics",
    "pharmacy": "pharmacies",
    "doctors": "doctors",
    "supermarket": "supermarkets",
    "convenience": "convenience stores",
    "greengrocer": "grocers",
    "library": "libraries",
    "bank": "banks",
    "post_office": "post offices",
    "community_centre": "community centers",
    "police": "police",
    "fire_station": "fire stations",
    "place_of_worship": "places of worship",
    "park": "parks",
    "playground": "playgrounds",
    "garden": "gardens",
    "stadium": "stadiums",
    "museum": "museums",
}

# Time formats and zone of the Chicago feeds.
CTA_ZONE = "America/Chicago"
CTA_BUS_TIME_FORMATS = ("yyyyMMdd HH:mm:ss", "yyyyMMdd HH:mm")
CTA_TRAIN_TIME_FORMATS = ("yyyy-MM-dd'T'HH:mm:ss", "yyyyMMdd HH:mm:ss")
CTA_INACTIVE_ROUTE_MESSAGE = "No data found for parameter"

# Display texts of what lies around a stop, in the order of the counts.
DAILY_NEEDS = ["food options", "schools, healthcare, or groceries", "park/garden/play features"]
NO_DAILY_NEEDS = "No matched daily-needs POIs within 400m"

# Display texts of a vehicle's status, and those of city buses where they differ.
VEHICLE_STATUS = {
    "IN_TRANSIT_TO": "In transit", "STOPPED_AT": "Stopped", "INCOMING_AT": "Approaching stop",
}
CITY_BUS_STATUS = {"STOPPED_AT": "Delayed"}
OTHER_STATUS = "Unknown"
OTHER_CITY_BUS_STATUS = "Reporting live"

# From this share of the largest on, this tier.
AVAILABILITY_TIERS = [(0.82, "very high"), (0.55, "high"), (0.28, "moderate")]
# Above this share of the largest, this step.
LENS_STEPS = [(0.75, 3), (0.45, 2), (0.2, 1)]
# Below this number of trips, this tier.
TRIP_COUNT_TIERS = [(500, "lower"), (1000, "medium"), (1500, "high")]
# Map zoom for extents above this size in degrees.
ZOOM_LEVELS = [(0.7, 9.6), (0.45, 10.3), (0.2, 11.0), (0.08, 11.8), (0.03, 12.8)]
SMALLEST_ZOOM = 12.3
