"""Tiny French and British source files with every irregularity the readers handle."""

from __future__ import annotations

import os

NBSP = "\u00a0"

FR_FILES = {
    "caracteristiques_2005.csv": (
        "latin-1",
        "Num_Acc;mois;jour;lat;long;com;dep\n"
        f"A1{NBSP};1;5;48,85;2,35;75;750\n"
        "A2;2;30;6600000;700000;2A4;2A\n"  # impossible date, metric position
        "A3;12;9;x;2,0;0;380\n"
        "A4;7;14;;;12;N/A\n"
        "A5;8;1;45;1;5;59;trop;long\n"  # over-long: dropped
        "A6;3;3\n"  # short: filled
        "A7;4;4;45,1;1,5;7;Saône\n",
    ),
    "lieux_2005.csv": (
        "utf-8",
        "Num_Acc;catr;vma\nA1;1;130\nA1;3;90\nA2;9;-1\nA3;zz;50\nA4;4;nan\nA6;2;110\n",
    ),
    "usagers_2005.csv": (
        "utf-8",
        "Num_Acc;id_vehicule;an_nais;grav;sexe;place;catu\n"
        "A1;V2;1970;2;1;1;1\n"
        "A1;V1;1980.0;3;2;0;2\n"
        "A1;V2;None;4;1;-1;3\n"
        "A3;V1;19x0;3;-1;2;9\n"
        "A4;V9;1990;1;2;3;1\n"  # vehicle not listed
        "A6;;1985;4;2;1;1\n",
    ),
    "vehicules_2005.csv": (
        "utf-8",
        "Num_Acc;id_vehicule;catv;manv;occutc;motor\n"
        "A1;V1;7;1;2;1\nA1;V2;33;13;0;5\nA1;V2;1;0;;-1\nA3;V1;10;99;-4;3\nA6;;2;2;x;0\nA4;V1;7;1;1;1\n",
    ),
    # A year with commas and without vehicle numbers.
    "caracteristiques_2007.csv": ("utf-8", 'Num_Acc,mois,jour,lat,long,com,dep\nB1,1,5,"48,1",2,31,310\n'),
    "lieux_2007.csv": ("utf-8", "Num_Acc,catr,vma\nB1,2,80\n"),
    "usagers_2007.csv": ("utf-8", "Num_Acc,an_nais,grav,sexe,place,catu\nB1,2000,2,1,1,1\nB1,2001,1,2,2,2\n"),
    "vehicules_2007.csv": ("utf-8", "Num_Acc,catv,manv,occutc,motor\nB1,7,1,4,1\nB1,30,2,1,3\n"),
}

PREFIX = "dft-road-casualty-statistics"
UK_FILES = {
    f"{PREFIX}-collision-2005.csv": (
        "utf-8",
        "accident_index,date,local_authority_ons_district,first_road_class,speed_limit,latitude,longitude\n"
        "U1,05/01/2005,E09000001,3,30,51.5000004,-0.1\n"
        "U2,2005-02-01,E09000002,6,70,,\n"
        "U3,99/99/2005,E09000003,1,-1,52,1\n",
    ),
    f"{PREFIX}-casualty-2005.csv": (
        "utf-8",
        "accident_index,casualty_class,sex_of_casualty,age_band_of_casualty,age_of_casualty,casualty_severity\n"
        "U1,1,1,6,33,1\nU1,2,2,5,-1,2\nU2,3,3,4,20,3\nU3,1,1,1,1,3\n",
    ),
    f"{PREFIX}-vehicle-2005.csv": (
        "utf-8",
        "accident_index,vehicle_type,vehicle_manoeuvre_historic,vehicle_manoeuvre,propulsion_code\n"
        "U1,9,1,18,1\nU1,19,1,3,2\nU2,109,1,6,8\nU3,5,1,2,2\n",
    ),
}

METEO_FR = {
    "meteo_fr_2005.csv": (
        "utf-8",
        "POSTE;DATE;T;TINF_H;TSUP_H;FF;PRELIQ\n"
        "1;20050105;3;1;5;10;0\n"
        "2;20050105;5;3;25;20;\n"
        "1;20050801;20;15;30;;1\n"
        "1;20061209;1;1;1;1;1\n"  # year outside the warehouse
        "1;20051209;1;0;2;;9\n",
    ),
    "meteo_fr_2007.csv": (
        "utf-8",
        "POSTE,DATE,T,FF\n1,20070105,10,50\n1,20051209,99,99\n",  # second file repeats a day
    ),
}
METEO_UK = {
    "meteo_uk_2005.csv": (
        "utf-8",
        "date,temp,precipitation,wind_speed\n2005-01-05,8,0.5,30\n2005-02-01,21,2,\nbad,1,1,1\n",
    ),
}


def write_raw(root: str) -> dict[str, str]:
    folders = {"accidents_fr": FR_FILES, "accidents_uk": UK_FILES, "meteo_fr": METEO_FR, "meteo_uk": METEO_UK}
    paths = {}
    for name, files in folders.items():
        paths[name] = os.path.join(root, name)
        os.makedirs(paths[name])
        for file, (encoding, text) in files.items():
            with open(os.path.join(paths[name], file), "w", encoding=encoding, newline="") as out:
                out.write(text)
    return paths
