"""What a tagged way becomes: walking and riding by direction, bike class, flags and name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tag values of the profile rules.
ROUTED = ("trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link", "unclassified", "residential", "living_street", "service", "road", "footway", "path", "cycleway", "pedestrian", "steps", "track", "bridleway")
GRANTS = ("yes", "designated", "permissive", "destination", "official", "customers", "delivery", "discouraged")
DENIES = ("no", "private")
ARTERIAL = ("trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link", "tertiary", "tertiary_link")
ASK_FIRST = ("trunk", "trunk_link", "footway", "path", "pedestrian", "bridleway")
PATHS = ("footway", "path", "cycleway", "pedestrian", "steps", "track", "bridleway")
OFF_ROAD = ("footway", "path", "track", "bridleway")
SIDEWALK = ("sidewalk", "crossing", "traffic_island", "link", "access_aisle")
CLASS_OF_SIDE = {"protected": ("track", "separate", "opposite_track"), "painted": ("lane", "share_busway", "opposite_lane", "opposite_share_busway"), "shared": ("shared_lane", "shoulder", "opposite")}


def classify(tags: Column) -> dict[str, Column]:
    """drop (reason or null), walk, bike_forward, bike_backward, class_forward, class_backward, bridge, stairs, name, name_kind, sidewalk."""
    t = lambda key: tags[key]
    has = lambda c, values: F.coalesce(c.isin(*values), F.lit(False))
    highway = t("highway")
    plaza = has(t("area"), ("yes",)) & has(highway, ("pedestrian", "footway"))
    sidewalk = has(t("footway"), SIDEWALK) | has(t("path"), SIDEWALK) | (has(highway, ("footway", "path")) & t("crossing").isNotNull() & ~has(t("crossing"), ("no",)))
    drop = (
        F.when(highway.isNull(), "no highway")
        .when(~has(highway, ROUTED), "not routed")
        .when(has(t("motorroad"), ("yes",)), "motorroad")
        .when(has(t("area"), ("yes",)) & ~plaza, "area")
    )
    foot_grant, bike_grant = has(t("foot"), GRANTS), has(t("bicycle"), GRANTS)
    no_access = has(t("access"), DENIES)
    bare = ("no", "none")
    no_sidewalk = has(highway, ("trunk", "trunk_link")) & (has(t("sidewalk"), bare) | has(t("sidewalk:both"), bare) | (has(t("sidewalk:left"), bare) & has(t("sidewalk:right"), bare)))
    walk = drop.isNull() & ~sidewalk & ~no_sidewalk & ~has(t("foot"), DENIES) & (~no_access | foot_grant)
    closed = has(t("bicycle"), ("no", "private", "use_sidepath", "dismount")) | ((no_access | has(t("vehicle"), DENIES)) & ~bike_grant)
    kept_sidewalk = has(highway, ("cycleway",)) | bike_grant
    rides = drop.isNull() & ~has(highway, ("steps",)) & ~plaza & ~closed & (~has(highway, ASK_FIRST) | bike_grant) & (~sidewalk | kept_sidewalk)
    # direction: 1 with the way, -1 against it, 0 both, 2 none
    as_direction = lambda c: F.when(has(c, ("yes", "true", "1")), 1).when(has(c, ("-1", "reverse")), -1).when(has(c, ("reversible", "alternating")), 2).when(c.isNotNull(), 0)
    circle = has(t("junction"), ("roundabout", "circular"))
    road = F.coalesce(as_direction(t("oneway")), F.when(circle, 1).otherwise(0))
    sides = ("cycleway", "cycleway:both", "cycleway:left", "cycleway:right")
    lanes = CLASS_OF_SIDE["protected"] + CLASS_OF_SIDE["painted"]
    counter = F.lit(False)
    for side in sides:
        own = t(f"{side}:oneway")
        counter = counter | F.coalesce(t(side).startswith("opposite"), F.lit(False))
        counter = counter | (has(t(side), lanes) & F.when(road == 1, has(own, ("-1", "no"))).when(road == -1, has(own, ("yes", "no"))).otherwise(F.lit(False)))
    bike_way = F.coalesce(as_direction(t("oneway:bicycle")), F.when(counter & road.isin(1, -1), 0).otherwise(road))
    forward, backward = rides & bike_way.isin(0, 1), rides & bike_way.isin(0, -1)

    def class_in(direction: int) -> Column:
        ranks = []
        for side in sides:
            own = as_direction(t(f"{side}:oneway"))
            usual = {"cycleway:right": 1, "cycleway:left": -1}.get(side, 0)
            serves = F.coalesce(F.when(t(side).startswith("opposite"), F.when(road == -1, 1).otherwise(-1)), own, F.when(road.isin(1, -1), road), F.lit(usual))
            kind = F.lit(3)
            for number, values in enumerate(CLASS_OF_SIDE.values()):
                kind = F.when(has(t(side), values), number).otherwise(kind)
            ranks.append(F.when(serves.isin(0, direction), kind).otherwise(3))
        base = F.when(has(highway, ("cycleway",)) | has(highway, OFF_ROAD), 0).when(has(highway, ARTERIAL), 3).otherwise(2)
        best = F.array_min(F.array(*ranks))
        names = F.array(*map(F.lit, ("protected", "painted", "shared", "arterial")))
        return F.element_at(names, F.least(best, base) + 1)

    bridge = t("bridge").isNotNull() & ~has(t("bridge"), ("no",))
    empty = lambda c: F.coalesce(c, F.lit("")) != ""
    ref = F.array_join(F.transform(F.split(t("ref"), ";"), lambda x: F.trim(x)), " / ")
    service = F.when(has(t("service"), ("driveway",)), "driveway").when(has(t("service"), ("parking_aisle",)), "parking aisle").when(has(t("service"), ("alley",)), "alley").otherwise("service road")
    label = (
        F.when(highway == "service", service)
        .when(plaza, "plaza")
        .when(bridge & has(highway, PATHS), "bridge path")
        .when(highway == "footway", "footpath")
        .when(highway == "path", "path")
        .when(highway == "cycleway", "bike path")
        .when(highway == "steps", "steps")
        .when(highway == "pedestrian", "pedestrian street")
        .when(highway == "track", "track")
        .when(highway == "bridleway", "bridle path")
        .otherwise("road")
    )
    name = F.when(empty(t("name")), t("name")).when(bridge & empty(t("bridge:name")), t("bridge:name")).when(empty(t("ref")), ref).otherwise(label)
    kind = F.when(empty(t("name")) | (bridge & empty(t("bridge:name"))), "name").when(empty(t("ref")), "ref").otherwise("label")
    left = drop.isNull() & ~walk & ~forward & ~backward
    return {
        "drop": F.coalesce(drop, F.when(left & sidewalk, "sidewalk").when(left, "no access")),
        "walk": walk,
        "bike_forward": forward,
        "bike_backward": backward,
        "class_forward": F.when(forward, class_in(1)),
        "class_backward": F.when(backward, class_in(-1)),
        "bridge": bridge,
        "stairs": has(highway, ("steps",)),
        "name": F.when(drop.isNull(), name),
        "name_kind": F.when(drop.isNull(), kind),
        "sidewalk": sidewalk,
    }
